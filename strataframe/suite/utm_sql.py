"""The transverse-Mercator series as nested SQL text, for the oracles."""

from __future__ import annotations

from ..functions.utm import _ALPHA, _BETA, _C, _DELTA, _KA, FALSE_EASTING, FALSE_NORTHING_SOUTH


def _r(x: float) -> str:
    return repr(float(x))


def central_meridian_sql(zone: str) -> str:
    return f"radians(({zone}) * 6.0 - 183.0)"


def inverse_sql(easting: str, northing: str, zone: str, south: str = "false") -> tuple[str, str]:
    """(lat, lon) in degrees from UTM (easting, northing, zone)."""
    xi = f"((({northing}) - CASE WHEN {south} THEN {_r(FALSE_NORTHING_SOUTH)} ELSE 0.0 END) / {_r(_KA)})"
    eta = f"((({easting}) - {_r(FALSE_EASTING)}) / {_r(_KA)})"
    xi_p = xi + "".join(f" - {_r(b)} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, b in enumerate(_BETA, 1))
    eta_p = eta + "".join(f" - {_r(b)} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, b in enumerate(_BETA, 1))
    chi = f"asin(sin({xi_p}) / cosh({eta_p}))"
    lat = f"degrees({chi}" + "".join(f" + {_r(d)} * sin({2 * j} * {chi})" for j, d in enumerate(_DELTA, 1)) + ")"
    lon = f"degrees({central_meridian_sql(zone)} + atan(sinh({eta_p}) / cos({xi_p})))"
    return lat, lon


def forward_sql(lat: str, lon: str, zone: str, south: str = "false") -> tuple[str, str]:
    """(easting, northing) in metres from (lat, lon) degrees in ``zone``."""
    phi = f"radians({lat})"
    dl = f"(radians({lon}) - {central_meridian_sql(zone)})"
    t = f"sinh(atanh(sin({phi})) - {_r(_C)} * atanh({_r(_C)} * sin({phi})))"
    xi = f"atan({t} / cos({dl}))"
    eta = f"atanh(sin({dl}) / sqrt(1 + ({t}) * ({t})))"
    e = f"{_r(FALSE_EASTING)} + {_r(_KA)} * ({eta}" + "".join(
        f" + {_r(a)} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, a in enumerate(_ALPHA, 1)) + ")"
    n = f"CASE WHEN {south} THEN {_r(FALSE_NORTHING_SOUTH)} ELSE 0.0 END + {_r(_KA)} * ({xi}" + "".join(
        f" + {_r(a)} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, a in enumerate(_ALPHA, 1)) + ")"
    return e, n


def reproject_sql(easting: str, northing: str, from_zone: str, to_zone: str) -> tuple[str, str]:
    lat, lon = inverse_sql(easting, northing, from_zone)
    return forward_sql(f"({lat})", f"({lon})", to_zone)
