"""Checked queries for metadata tables: variables (S2, S3, S5, S6, S10-S12),
strict casts (S9), URIs (C34), sensors and DOIs (C27, C29), attributes (E10)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import times
from ..operators import schema as S
from ..operators import series as E
from ..sources import catalog as K
from .registry import register
from .schema_suite import FEW_PARTS, VARIABLES_SQL, variables, variables_sql
from .shapes import shape

_V = VARIABLES_SQL.replace("AS string", "AS varchar")

ADDED = [
    ("domainID", "domain", "string"), ("siteID", "site", "string"),
    ("horizontalPosition", "horizontal index", "string"), ("verticalPosition", "vertical index", "string"),
    ("publicationDate", "publication", "string"), ("release", "release tag", "string"),
]


def added_fields(spark):
    return spark.createDataFrame(ADDED, "fieldName string, description string, dataType string")


def _extended_sql(positioned: bool) -> str:
    rows = [(i, *r, 0 if r[0] in S.POSITION_FIELDS else 2) for i, r in enumerate(ADDED) if positioned or r[0] not in S.POSITION_FIELDS]
    values = ", ".join(f"({i}, '{n}', '{d}', '{t}', {k})" for i, n, d, t, k in rows)
    return f"""
WITH v AS ({_V}),
a AS (SELECT * FROM (VALUES {values}) t(sub, fieldName, description, dataType, rnk)),
u AS (SELECT "table" AS tab, fieldName, dataType, 1 AS rnk, row_no AS sub FROM v
      UNION ALL SELECT tab, fieldName, dataType, rnk, sub FROM a, (SELECT DISTINCT "table" AS tab FROM v) t)
SELECT tab AS table_name, fieldName, dataType, cast(row_number() OVER (PARTITION BY tab ORDER BY rnk, sub) AS bigint) AS row_no FROM u
"""


@register("extend_variables", _extended_sql(False))
def q_extend_variables(spark, sf_dir):
    out = S.extend_variables(variables(spark, sf_dir), added_fields(spark), with_position=False)
    return out.select(F.col("table").alias("table_name"), "fieldName", "dataType", F.col("row_no").cast("bigint").alias("row_no"))


@register("extend_variables_positioned", _extended_sql(True))
def q_extend_variables_positioned(spark, sf_dir):
    out = S.extend_variables(variables(spark, sf_dir), added_fields(spark), with_position=True)
    return out.select(F.col("table").alias("table_name"), "fieldName", "dataType", F.col("row_no").cast("bigint").alias("row_no"))


@register("patch_variables", f"""
WITH v AS ({_V})
SELECT "table" AS table_name, fieldName FROM v
UNION ALL SELECT 'tab_1', 'g_' || cast(p_partkey AS varchar) FROM part WHERE p_partkey % 3 = 1 AND p_partkey % 2 = 0
""")
def q_patch_variables(spark, sf_dir):
    base = variables(spark, sf_dir)
    extra = shape(spark, sf_dir, """
SELECT 'tab_' || cast(p_partkey % 3 AS string) AS `table`,
       CASE WHEN p_partkey % 2 = 0 THEN 'g_' ELSE 'f_' END || cast(p_partkey AS string) AS fieldName FROM part""")
    out = S.patch_variables(base, extra, "tab_1", present=True)
    return S.patch_variables(out, extra, "tab_2", present=False).select(F.col("table").alias("table_name"), "fieldName")


@register("split_by_table", f"""
WITH v AS ({_V}) SELECT "table" AS table_name, cast(count(*) AS bigint) AS n_fields FROM v GROUP BY 1
""")
def q_split_by_table(spark, sf_dir):
    parts = S.split_by_table(variables(spark, sf_dir))
    counted = [df.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).cast("bigint").alias("n_fields")) for t, df in parts.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


_FEW = variables_sql(FEW_PARTS)


@register("variables_differ", f"""
WITH v AS ({_FEW.replace("AS string", "AS varchar")}), w AS (
  SELECT "table", fieldName, CASE WHEN row_no % 10 = 0 THEN 'string' ELSE dataType END AS dataType FROM v WHERE row_no % 7 <> 0)
SELECT t.tab AS table_name, EXISTS (
    (SELECT fieldName, dataType FROM v WHERE "table" = t.tab EXCEPT ALL SELECT fieldName, dataType FROM w WHERE "table" = t.tab)
    UNION ALL
    (SELECT fieldName, dataType FROM w WHERE "table" = t.tab EXCEPT ALL SELECT fieldName, dataType FROM v WHERE "table" = t.tab)) AS differs
FROM (VALUES ('tab_0'), ('tab_1'), ('tab_2')) t(tab)
UNION ALL SELECT 'tab_0 with itself', false
""")
def q_variables_differ(spark, sf_dir):
    v = variables(spark, sf_dir, _FEW)
    w = v.filter("row_no % 7 <> 0").withColumn("dataType", F.when(F.col("row_no") % 10 == 0, "string").otherwise(F.col("dataType")))
    rows = [(t, S.variables_differ(v, w, t)) for t in ("tab_0", "tab_1", "tab_2")]
    rows.append(("tab_0 with itself", S.variables_differ(v, v, "tab_0")))
    return spark.createDataFrame(rows, "table_name string, differs boolean")


@register("string_schema", f"""
WITH v AS ({_V}) SELECT cast(row_number() OVER (ORDER BY row_no) AS int) AS position, fieldName AS field, 'string' AS type FROM v
""")
def q_string_schema(spark, sf_dir):
    return S.schema_table(S.string_schema(variables(spark, sf_dir), collect=False))


RAW_SQL = """
SELECT event_id, cast(value AS string) AS num, CASE WHEN event_id % 9 = 0 THEN 'NA' ELSE event_type END AS txt,
  cast(year(ts) AS string) || '-' || lpad(cast(month(ts) AS string), 2, '0') || '-' || lpad(cast(day(ts) AS string), 2, '0') AS day,
  cast(user_id AS string) AS horizontalPosition
FROM events
"""


@register("cast_by_variables", """
SELECT event_id, value AS num, CASE WHEN event_id % 9 <> 0 THEN event_type END AS txt,
  cast(cast(ts AS date) AS timestamp) AS day, cast(user_id AS varchar) AS horizontalPosition FROM events
""")
def q_cast_by_variables(spark, sf_dir):
    fields = [("t", "num", "real"), ("t", "txt", "string"), ("t", "day", "dateTime"), ("t", "horizontalPosition", "integer")]
    out = S.cast_by_variables(shape(spark, sf_dir, RAW_SQL), spark.createDataFrame(fields, "`table` string, fieldName string, dataType string"))
    return out.withColumn("day", F.col("day").cast("timestamp_ntz"))


@register("parse_timestamps_per_column", """
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN cast(cast(ts AS date) AS timestamp) END AS whole,
  CASE WHEN event_id % 3 <> 0 THEN date_trunc('minute', ts) END AS minute, cast(year(ts) AS bigint) AS year
FROM events
""")
def q_parse_timestamps_per_column(spark, sf_dir):
    day = "date_format(ts, 'yyyy-MM-dd')"
    rows = shape(spark, sf_dir, f"""
SELECT event_id, {day} || CASE WHEN event_id % 5 = 0 THEN 'garbage' ELSE '' END AS whole,
  {day} || date_format(ts, "'T'HH:mm'Z'") || CASE WHEN event_id % 3 = 0 THEN '!' ELSE '' END AS minute,
  date_format(ts, 'yyyy') AS year FROM events""")
    return rows.select(
        "event_id",
        times.parse_pub_format("whole", "yyyy-MM-dd").cast("timestamp_ntz").alias("whole"),
        times.parse_pub_format("minute", "yyyy-MM-dd'T'HH:mm'Z'(floor)").cast("timestamp_ntz").alias("minute"),
        times.parse_pub_format("year", "yyyy(floor)").alias("year"),
    )


# One table whose cells all cast, one with trailing junk after some dates.
DATES_SQL = """
SELECT event_id, cast(year(ts) AS string) || '-' || lpad(cast(month(ts) AS string), 2, '0') || '-' || lpad(cast(day(ts) AS string), 2, '0')
  AS d, event_id % 13 AS k FROM events
"""


@register("strict_cast_table", f"""
SELECT 'clean' AS input, event_id, cast(d AS varchar) AS d FROM ({DATES_SQL.replace('AS string', 'AS varchar')}) s
UNION ALL
SELECT 'junk', event_id, d || CASE WHEN k = 0 THEN 'garbage' ELSE '' END FROM ({DATES_SQL.replace('AS string', 'AS varchar')}) s
UNION ALL
SELECT 'types', 0, 'date,string' WHERE (SELECT count(*) FROM events) > 0
""")
def q_strict_cast_table(spark, sf_dir):
    raw = shape(spark, sf_dir, DATES_SQL)
    schema = T.StructType([T.StructField("d", T.DateType(), True, {"dataType": "dateTime", "pubFormat": "yyyy-MM-dd"})])
    junk = raw.withColumn("d", F.concat("d", F.when(F.col("k") == 0, "garbage").otherwise("")))
    parts, kinds = [], []
    for name, df in (("clean", raw), ("junk", junk)):
        typed, _ = S.strict_cast_or_strings(df, schema)
        kinds.append(typed.schema["d"].dataType.simpleString())
        parts.append(typed.select(F.lit(name).alias("input"), F.col("event_id").cast("bigint").alias("event_id"), F.col("d").cast("string").alias("d")))
    said = spark.createDataFrame([("types", 0, ",".join(kinds))], "input string, event_id long, d string")
    return parts[0].unionByName(parts[1]).unionByName(said)


@register("unpivot_uris", """
SELECT DISTINCT 'log' AS table_name, 'link' AS fieldName, 'https://files/' || cast(user_id AS varchar) AS uri FROM events WHERE event_id % 4 <> 0
UNION SELECT 'orders', 'scan', 'https://scans/' || cast(o_custkey AS varchar) FROM orders
""")
def q_unpivot_uris(spark, sf_dir):
    log = shape(spark, sf_dir, "SELECT CASE WHEN event_id % 4 = 0 THEN 'NA' ELSE 'https://files/' || cast(user_id AS string) END AS link FROM events")
    orders = shape(spark, sf_dir, "SELECT 'https://scans/' || cast(o_custkey AS string) AS scan, o_orderstatus FROM orders")
    declared = [("log", "link", "uri"), ("orders", "scan", "uri"), ("orders", "o_orderstatus", "string"), ("gone", "x", "uri")]
    fields = spark.createDataFrame(declared, "`table` string, fieldName string, dataType string")
    return S.unpivot_uris({"log": log, "orders": orders}, fields).withColumnRenamed("table", "table_name")


@register("product_sensors", """
SELECT 'P' || cast(p_size AS varchar) AS product, p_name AS name, p_type AS sensor FROM part
""")
def q_product_sensors(spark, sf_dir):
    rows = shape(spark, sf_dir, "SELECT 'P' || cast(p_size AS string) AS product, p_name, p_type, p_partkey FROM part")
    sensors = F.array(F.struct(F.col("p_name").alias("name"), F.col("p_type").alias("sensor")))
    doc = F.to_json(F.struct(F.struct(F.col("product").alias("productCode"), sensors.alias("productSensors")).alias("data")))
    return K.product_sensors(rows.select(doc.alias("json"))).select("product", "name", "sensor")


@register("doi_table", """
SELECT 'DP1.' || lpad(cast(p_partkey % 90000 + 10000 AS varchar), 5, '0') || '.001' AS DPID, p_name AS name,
  'RELEASE-' || cast(2021 + p_size % 4 AS varchar) AS release, '10.1/' || cast(p_partkey AS varchar) AS DOI FROM part
""")
def q_doi_table(spark, sf_dir):
    rows = shape(spark, sf_dir, """
SELECT 'https://data/DP1.' || lpad(cast(p_partkey % 90000 + 10000 AS string), 5, '0') || '.001/RELEASE-' || cast(2021 + p_size % 4 AS string) AS url,
  'https://doi.org/10.1/' || cast(p_partkey AS string) AS doi, p_name FROM part""")
    doc = F.to_json(F.struct("url", "doi", F.array(F.struct(F.col("p_name").alias("title"))).alias("titles")))
    return K.doi_table(rows.select(doc.alias("json")))


@register("series_attributes", """
SELECT 'ST' || cast(user_id AS varchar) AS site, strftime(ts, '%Y-%m-%d') AS date,
  max('1,' || cast(user_id AS varchar)) FILTER (WHERE event_type = 'click') AS click,
  max('2,' || cast(user_id AS varchar)) FILTER (WHERE event_type = 'view') AS view
FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2
""")
def q_series_attributes(spark, sf_dir):
    rows = shape(spark, sf_dir, """
SELECT 'ST' || cast(user_id AS string) AS site, date_format(ts, 'yyyy-MM-dd') AS date, event_type AS attr,
  array(CASE WHEN event_type = 'click' THEN '1' ELSE '2' END, cast(user_id AS string)) AS values
FROM events WHERE event_type IN ('click', 'view')""")
    return E.series_attributes(rows, ["click", "view"])
