"""Metadata ``dataType``/``pubFormat`` to Spark types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metadata data types and publication formats.
STRING_TYPES = ("string", "uri")
REAL_TYPES = ("real",)
INTEGER_TYPES = ("integer", "unsigned integer", "signed integer")
SECOND_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss'Z'(floor)",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss'Z'(round)",
    "yyyy-MM-dd'T'HH:mm'Z'(floor)",
    "yyyy-MM-dd'T'HH:mm'Z'",
    "yyyy-MM-dd'T'HH:mm'Z'(round)",
    "yyyy-MM-dd'T'HH'Z'(floor)",
    "yyyy-MM-dd'T'HH'Z'",
    "yyyy-MM-dd'T'HH'Z'(round)",
)
MILLI_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",)
DAY_FORMATS = ("yyyy-MM-dd(floor)", "yyyy-MM-dd")
YEAR_FORMATS = ("yyyy(floor)", "yyyy(round)")


def spark_type(data_type: str | None, pub_format: str | None) -> T.DataType:
    """Spark type for one metadata row; anything unmatched is a string."""
    dt = (data_type or "").strip()
    fmt = (pub_format or "").strip()
    if dt in REAL_TYPES:
        return T.DoubleType()
    if dt in INTEGER_TYPES:
        return T.LongType()
    if dt == "dateTime":
        if fmt in SECOND_FORMATS or fmt in MILLI_FORMATS:
            return T.TimestampType()
        if fmt in DAY_FORMATS:
            return T.DateType()
        if fmt in YEAR_FORMATS:
            return T.LongType()
    return T.StringType()


def spark_type_name(data_type: Column, pub_format: Column) -> Column:
    """The name of :func:`spark_type`, for metadata rows that stay in Spark."""
    blank = F.lit(" \t\n\r\x0b\x0c")
    dt, fmt = (F.btrim(F.coalesce(c, F.lit("")), blank) for c in (data_type, pub_format))
    date = dt == "dateTime"
    return (
        F.when(dt.isin(*REAL_TYPES), T.DoubleType().simpleString())
        .when(dt.isin(*INTEGER_TYPES) | (date & fmt.isin(*YEAR_FORMATS)), T.LongType().simpleString())
        .when(date & fmt.isin(*SECOND_FORMATS, *MILLI_FORMATS), T.TimestampType().simpleString())
        .when(date & fmt.isin(*DAY_FORMATS), T.DateType().simpleString())
        .otherwise(T.StringType().simpleString())
    )


def spark_format(pub_format: str | None) -> str | None:
    """Spark datetime pattern for a publication format (suffix dropped,
    trailing ``'Z'`` kept as a literal)."""
    if not pub_format:
        return None
    return pub_format.replace("(floor)", "").replace("(round)", "").strip()
