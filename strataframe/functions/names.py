"""Column expressions that read identity out of published file names.

A published file carries its identity in its dotted basename and in its
parent directory: domain, site, product, sensor position (HOR/VER/TMI),
month, package, publication stamp and release.  Everything here is a
plain Catalyst expression (``regexp_extract``/``split``/...), so it runs
inside whole-stage codegen on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The naming convention of the published files.
STAMP_PATTERN = r"[0-9]{8}T[0-9]{6}Z"
RELEASE_TAG = r"^(RELEASE-[0-9]{4}|PROVISIONAL|LATEST)$"
DOMAIN_PATTERN = r"\.(D[0-2][0-9])\."
SITE_PATTERN = r"\.D[0-9]{2}\.([A-Z]{4}|[A-Z]{2}[0-9]{2})\."
LOCATION_PATTERN = r"\.[0-9]{3}\.([0-9]{3})\.([0-9]{3})\.([0-9]{3}|[0-9]{2}[A-Z])\."
MONTH_PATTERN = r"[0-9]{4}-[0-9]{2}"
PRODUCT_PATTERN = r"DP[1-4]\.[0-9]{5}\.00[1-2]"
PACKAGE_PATTERN = r"\.(basic|expanded)\."
DATA_FILE_PATTERN = r"\.[a-z]{3}$"
METADATA_TABLES = ("sensor_positions", "science_review_flags")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract(c, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def basename(path) -> Column:
    """Last path component (``substring_index``: linear, no regex)."""
    return F.substring_index(_col(path), "/", -1)


def plain_path(path) -> Column:
    """A path without the ways to write a local scheme."""
    return F.regexp_replace(_col(path), "^file:/+", "/")


def dirname(path) -> Column:
    """Everything before the last ``/`` (empty when there is none)."""
    p = _col(path)
    keep = F.length(p) - F.length(F.substring_index(p, "/", -1)) - 1
    return F.when(keep > 0, F.substring(p, F.lit(1), keep)).otherwise(F.lit(""))


def name_parts(name) -> Column:
    return F.split(_col(name), r"\.")


def publication_stamp(text) -> Column:
    """First ``yyyyMMddTHHmmssZ`` stamp in the text, null when absent."""
    return _extract(text, STAMP_PATTERN)


def domain_of(name) -> Column:
    return _extract(name, DOMAIN_PATTERN, 1)


def site_of(name) -> Column:
    return _extract(name, SITE_PATTERN, 1)


def product_of(name) -> Column:
    return _extract(name, PRODUCT_PATTERN)


def month_of(name) -> Column:
    return _extract(name, MONTH_PATTERN)


def package_of(name) -> Column:
    return _extract(name, PACKAGE_PATTERN, 1)


def hor_of(name) -> Column:
    return _extract(name, LOCATION_PATTERN, 1)


def ver_of(name) -> Column:
    return _extract(name, LOCATION_PATTERN, 2)


def time_index_of(name) -> Column:
    return _extract(name, LOCATION_PATTERN, 3)


def release_of(path) -> Column:
    """The last dot part of the parent folder's name, if it is a release tag."""
    last = F.substring_index(basename(dirname(path)), ".", -1)
    return F.when(last.rlike(RELEASE_TAG), last)


def table_of(name, max_length: int | None = None) -> Column:
    """Data-table name: first dot part from the third on that, with ``_pub``
    removed, contains ``_`` and is not one of the metadata tables; with
    ``max_length``, longer parts don't count."""
    parts = name_parts(name)
    cleaned = F.transform(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), lambda p: F.regexp_replace(p, "_pub", ""))

    def is_table(p):
        found = p.contains("_") & ~p.isin(*METADATA_TABLES)
        return found if max_length is None else found & (F.length(p) <= max_length)

    return F.try_element_at(F.filter(cleaned, is_table), F.lit(1))


def metadata_table_of(name) -> Column:
    """``sensor_positions`` / ``science_review_flags`` when the name holds one."""
    parts = name_parts(name)
    return (
        F.when(F.array_contains(parts, "sensor_positions"), F.lit("sensor_positions"))
        .when(F.array_contains(parts, "science_review_flags"), F.lit("science_review_flags"))
    )


def table_type_of(name) -> Column:
    """``lab`` without a ``Dnn`` part, ``site-date`` with a ``YYYY-MM`` part,
    else ``site-all``."""
    parts = F.filter(name_parts(name), lambda p: p != "")
    has_domain = F.exists(parts, lambda p: p.rlike(r"^D[0-9]{2}$"))
    has_month = F.exists(parts, lambda p: p.rlike(MONTH_PATTERN))
    return (
        F.when(~has_domain, F.lit("lab"))
        .when(has_month, F.lit("site-date"))
        .otherwise(F.lit("site-all"))
    )


def lab_of(name) -> Column:
    """Lab name = second dot part of a name without a domain."""
    return F.when(domain_of(name).isNull(), F.try_element_at(name_parts(name), F.lit(2)))
