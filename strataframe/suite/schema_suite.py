"""Checked queries for the schema operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import schema as S
from .registry import register
from .shapes import shape

_Q = "chr(39)"
_SEC_FMT = f"'yyyy-MM-dd' || {_Q} || 'T' || {_Q} || 'HH:mm:ss' || {_Q} || 'Z' || {_Q} || '(floor)'"

# Some hundred fields, as published tables have, however many parts there are.
FEW_PARTS = "(SELECT p_size * 10 + p_partkey % 10 AS p_partkey, min(p_name) AS p_name, p_size FROM part GROUP BY p_size, p_partkey % 10) p"


def variables_sql(parts: str) -> str:
    return f"""
SELECT 'tab_' || cast(p_partkey % 3 AS string) AS "table", 'f_' || cast(p_partkey AS string) AS fieldName,
  p_name AS description,
  CASE p_size % 6 WHEN 0 THEN 'string' WHEN 1 THEN 'real' WHEN 2 THEN 'unsigned integer'
       WHEN 3 THEN 'dateTime' WHEN 4 THEN 'uri' ELSE 'signed integer' END AS dataType,
  CASE WHEN p_partkey % 2 = 0 THEN 'basic' ELSE 'expanded' END AS downloadPkg,
  CASE p_size % 4 WHEN 0 THEN {_SEC_FMT} WHEN 1 THEN 'yyyy-MM-dd' WHEN 2 THEN 'yyyy(floor)' ELSE 'asIs' END AS pubFormat,
  p_partkey AS row_no
FROM {parts}
"""


# A field for each part.
VARIABLES_SQL = variables_sql("part")


def variables(spark, sf_dir, sql=VARIABLES_SQL):
    return shape(spark, sf_dir, sql.replace('"table"', "`table`"))


@register("schema_from_variables", f"""
WITH v AS ({VARIABLES_SQL.replace('AS string', 'AS varchar')})
SELECT cast(row_number() OVER (ORDER BY row_no) AS int) AS position, fieldName AS field,
  CASE WHEN dataType = 'real' THEN 'double'
       WHEN dataType IN ('unsigned integer', 'signed integer', 'integer') THEN 'bigint'
       WHEN dataType = 'dateTime' AND pubFormat LIKE 'yyyy-MM-dd%HH%' THEN 'timestamp'
       WHEN dataType = 'dateTime' AND pubFormat = 'yyyy-MM-dd' THEN 'date'
       WHEN dataType = 'dateTime' AND pubFormat = 'yyyy(floor)' THEN 'bigint'
       ELSE 'string' END AS type
FROM v WHERE "table" = 'tab_1' AND downloadPkg = 'basic'
""")
def q_schema_from_variables(spark, sf_dir):
    return S.schema_table(S.schema_from_variables(variables(spark, sf_dir), "tab_1", "basic", collect=False))


@register("field_classes", f"""
WITH v AS ({VARIABLES_SQL.replace('AS string', 'AS varchar')})
SELECT fieldName, CASE WHEN dataType IN ('real', 'integer', 'unsigned integer', 'signed integer')
                       THEN 'numeric' ELSE 'character' END AS class FROM v
""")
def q_field_classes(spark, sf_dir):
    return S.field_classes(variables(spark, sf_dir))


_DAY = ("cast(year(ts) AS {t}) || '-' || lpad(cast(month(ts) AS {t}), 2, '0') || '-' || "
        "lpad(cast(day(ts) AS {t}), 2, '0')")
_HH = "lpad(cast(hour(ts) AS {t}), 2, '0')"
_MM = "lpad(cast(minute(ts) AS {t}), 2, '0')"
_SS = "lpad(cast(cast(floor(second(ts)) AS int) AS {t}), 2, '0')"


def _stamps_sql(t: str) -> str:
    day, hh, mm, ss = (x.format(t=t) for x in (_DAY, _HH, _MM, _SS))
    sec = f"{day} || 'T' || {hh} || ':' || {mm} || ':' || {ss} || 'Z'"
    mn = f"{day} || 'T' || {hh} || ':' || {mm} || 'Z'"
    return f"""
SELECT event_id, {sec} AS c_sec, {mn} AS c_min, {day} AS c_day,
  CASE event_id % 4 WHEN 0 THEN {sec} WHEN 1 THEN {mn} WHEN 2 THEN {day} ELSE {day} || 'T' || {hh} END AS c_mixed
FROM events
"""


@register("parse_dates_first_fit", f"""
WITH s AS ({_stamps_sql('varchar')})
SELECT event_id,
  strptime(substr(c_sec, 1, 19), '%Y-%m-%dT%H:%M:%S') AS c_sec,
  strptime(substr(c_min, 1, 16), '%Y-%m-%dT%H:%M') AS c_min,
  cast(strptime(c_day, '%Y-%m-%d') AS timestamp) AS c_day,
  CASE WHEN length(c_mixed) >= 19 THEN try_strptime(substr(c_mixed, 1, 19), '%Y-%m-%dT%H:%M:%S') END AS c_mixed
FROM s
""")
def q_parse_dates_first_fit(spark, sf_dir):
    s = shape(spark, sf_dir, _stamps_sql("string"))
    out = S.parse_dates_first_fit(s, ["c_sec", "c_min", "c_day", "c_mixed"])
    return out.select("event_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("c_sec", "c_min", "c_day", "c_mixed")])


MIXED_SQL = """
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'NA' WHEN 1 THEN 'bad' || cast(event_id AS string)
                 ELSE cast(value AS string) END AS v FROM events
"""


@register("strict_cast_or_strings", """
SELECT cast(count(*) FILTER (WHERE event_id % 7 = 1) AS bigint) AS bad_v FROM events
""")
def q_strict_cast_or_strings(spark, sf_dir):
    from pyspark.sql import types as T

    df = shape(spark, sf_dir, MIXED_SQL)
    schema = T.StructType([T.StructField("v", T.DoubleType())])
    return S.cast_failures(df, schema).select(F.col("bad_v").cast("bigint").alias("bad_v"))
