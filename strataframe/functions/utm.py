"""UTM <-> geographic coordinates as column maths (Krüger series to third
order in n, WGS84).  The formulas are the published transverse-Mercator series;
no UDF.  Every intermediate value is a column of its own that the next step
names, so the expressions stay short.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 ellipsoid and UTM constants.
A_AXIS = 6378137.0
FLATTENING = 1 / 298.257223563
K0 = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

_N = FLATTENING / (2 - FLATTENING)
_A = A_AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_C = 2 * math.sqrt(_N) / (1 + _N)
_KA = K0 * _A


def _staged(df: DataFrame, steps: list[dict[str, Column]]) -> DataFrame:
    for step in steps:
        df = df.withColumns(step)
    return df


def _meridian(zone: Column) -> Column:
    return F.radians(zone * 6.0 - 183.0)


def _series(base: Column, factors, first, second, x: Column, y: Column, sign: int) -> Column:
    out = base
    for j, f in enumerate(factors, 1):
        out = out + sign * f * first(2 * j * x) * second(2 * j * y)
    return out


def inverse(df: DataFrame, easting: Column, northing: Column, zone: Column, lat: str, lon: str) -> DataFrame:
    """``df`` plus latitude and longitude in degrees (northern hemisphere)."""
    xi, eta, xp, ep, chi = (F.col(c) for c in ("_xi", "_eta", "_xp", "_ep", "_chi"))
    out = _staged(df, [
        {"_xi": northing / _KA, "_eta": (easting - FALSE_EASTING) / _KA},
        {"_xp": _series(xi, _BETA, F.sin, F.cosh, xi, eta, -1), "_ep": _series(eta, _BETA, F.cos, F.sinh, xi, eta, -1)},
        {"_chi": F.asin(F.sin(xp) / F.cosh(ep))},
        {lat: F.degrees(chi + sum((d * F.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1)), F.lit(0.0))),
         lon: F.degrees(_meridian(zone) + F.atan(F.sinh(ep) / F.cos(xp)))},
    ])
    return out.drop("_xi", "_eta", "_xp", "_ep", "_chi")


def forward(df: DataFrame, lat: Column, lon: Column, zone: Column, easting: str, northing: str) -> DataFrame:
    """``df`` plus easting and northing in metres (northern hemisphere)."""
    s, dl, t, xi, eta = (F.col(c) for c in ("_s", "_dl", "_t", "_xi", "_eta"))
    out = _staged(df, [
        {"_s": F.sin(F.radians(lat)), "_dl": F.radians(lon) - _meridian(zone)},
        {"_t": F.sinh(F.atanh(s) - _C * F.atanh(_C * s))},
        {"_xi": F.atan(t / F.cos(dl)), "_eta": F.atanh(F.sin(dl) / F.sqrt(1 + t * t))},
        {easting: FALSE_EASTING + _KA * _series(eta, _ALPHA, F.cos, F.sinh, xi, eta, 1),
         northing: _KA * _series(xi, _ALPHA, F.sin, F.cosh, xi, eta, 1)},
    ])
    return out.drop("_s", "_dl", "_t", "_xi", "_eta")


def reproject(df: DataFrame, from_zone, to_zone, x: str, y: str, easting: str, northing: str) -> DataFrame:
    """UTM of one zone into another; zones are numbers or column names."""
    def zone(z):
        return F.col(z) if isinstance(z, str) else F.lit(int(z))

    placed = inverse(df, F.col(x), F.col(y), zone(from_zone), "_lat", "_lon")
    return forward(placed, F.col("_lat"), F.col("_lon"), zone(to_zone), easting, northing).drop("_lat", "_lon")
