"""Timestamp parsing expressions.

Declared formats match the whole cell.  Only the first-fit ladder reads a
prefix and ignores what follows.  The session time zone is UTC (see
``strataframe.session``), so parsed instants are UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first-fit ladder of date-time formats, most precise first,
# with the length of text each one reads.
FIRST_FIT_FORMATS = (
    ("second", "yyyy-MM-dd'T'HH:mm:ss", 19),
    ("minute", "yyyy-MM-dd'T'HH:mm", 16),
    ("hour", "yyyy-MM-dd'T'HH", 13),
    ("day", "yyyy-MM-dd", 10),
)
# Fractional seconds of one to nine digits and the closing Z may be missing.
SERIES_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]['Z']"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_prefix(c, fmt: str, width: int) -> Column:
    """``try_to_timestamp`` of the first ``width`` characters, null on failure.

    Text shorter than ``width`` can't match the format, so it is null."""
    text = F.trim(_col(c).cast("string"))
    head = F.substring(text, 1, width)
    return F.when(F.length(text) >= width, F.try_to_timestamp(head, F.lit(fmt)))


def parse_first_fit_candidates(c) -> list[tuple[str, Column]]:
    return [(label, parse_prefix(c, fmt, w)) for label, fmt, w in FIRST_FIT_FORMATS]


def parse_whole(c, fmt: str) -> Column:
    """``try_to_timestamp`` of the whole trimmed cell, null on failure."""
    return F.try_to_timestamp(F.trim(_col(c).cast("string")), F.lit(fmt))


def parse_series_time(c) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` with optional fractional seconds and ``Z``."""
    return parse_whole(c, SERIES_FORMAT)


def parse_pub_format(c, pub_format: str | None) -> Column:
    """Parse one column by its declared publication format; a cell with more
    text than the format is a failure.

    ``yyyy-MM-dd'T'HH:mm:ss.SSS'Z'`` keeps milliseconds; day formats give a
    date; year formats give a long; anything else stays text."""
    from .types import DAY_FORMATS, MILLI_FORMATS, SECOND_FORMATS, YEAR_FORMATS, spark_format

    col = _col(c)
    if pub_format in MILLI_FORMATS:
        return parse_series_time(col)
    if pub_format in SECOND_FORMATS:
        # floored stamps may be published with seconds, and without the Z
        fmt = spark_format(pub_format).replace("'Z'", "")
        fmt += {"yyyy-MM-dd'T'HH:mm": "[:ss]", "yyyy-MM-dd'T'HH": "[:mm][:ss]"}.get(fmt, "")
        return parse_whole(col, fmt + "['Z']")
    if pub_format in DAY_FORMATS:
        return parse_whole(col, "yyyy-MM-dd").cast("date")
    if pub_format in YEAR_FORMATS:
        return F.trim(col.cast("string")).try_cast("long")
    return col.cast("string")


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds as a double (both timestamps)."""
    return (F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))) / 1e6
