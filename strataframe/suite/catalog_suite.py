"""Checked queries for catalogue JSON (C25-C31).  Product documents are
built from ``events`` with ``to_json`` (the source); oracles read the flat
event rows directly."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import catalog as K
from .registry import register
from .shapes import shape

_PRODUCT = "'DP1.' || lpad(cast(10000 + user_id % 90000 AS {t}), 5, '0') || '.001'"
_SITE = "'ST0' || cast(event_id % 3 AS {t})"
_MONTH = "'2024-' || lpad(cast(1 + event_id % 12 AS {t}), 2, '0')"
_REL = "CASE WHEN event_id % 2 = 0 THEN 'RELEASE-2024' ELSE 'PROVISIONAL' END"
_PKG = "CASE WHEN event_type IN ('click', 'view') THEN 'basic' ELSE 'expanded' END"

FLAT_SQL = f"""
SELECT {_PRODUCT.format(t='string')} AS product, {_SITE.format(t='string')} AS site,
       {_MONTH.format(t='string')} AS month, {_REL} AS release, {_PKG} AS package,
       event_id, event_type, value, props
FROM events
"""


def documents(spark, sf_dir):
    """One JSON document per product, assembled from the events."""
    flat = shape(spark, sf_dir, FLAT_SQL)
    months = flat.groupBy("product", "site").agg(F.array_sort(F.collect_set("month")).alias("m"))
    sites = months.select(
        "product",
        F.struct(F.col("site").alias("siteCode"), F.col("m").alias("availableMonths"),
                 F.transform("m", lambda x: F.concat(F.lit("https://data/"), F.col("product"), F.lit("/"),
                                                      F.col("site"), F.lit("/"), x)).alias("availableDataUrls")).alias("s"),
    ).groupBy("product").agg(F.collect_list("s").alias("siteCodes"))
    files = flat.select("product", "release", "package", "site", "month", F.struct(
        F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("name"),
        F.concat(F.lit("https://files/"), F.col("event_id").cast("string")).alias("url"),
        F.md5(F.col("event_id").cast("string")).alias("md5"),
        (F.col("event_id") * 10).alias("size")).alias("f"))
    pk = files.groupBy("product", "release", "package", "site", "month").agg(F.collect_list("f").alias("files"))
    rel = pk.groupBy("product", "release").agg(
        F.collect_list(F.struct("package", F.col("site").alias("siteCode"), "month", "files")).alias("packages"))
    rels = rel.groupBy("product").agg(F.collect_list(F.struct("release", "packages")).alias("releases"))
    errs = flat.filter(F.col("event_type") == "error").select("product", F.struct(
        F.col("event_id").alias("id"), F.lit(None).cast("long").alias("parentIssueID"),
        F.lit("2024-01-01T00:00:00Z").alias("issueDate"), F.lit(None).cast("string").alias("resolvedDate"),
        F.lit(None).cast("string").alias("dateRangeStart"), F.lit(None).cast("string").alias("dateRangeEnd"),
        F.col("site").alias("locationAffected"), F.col("props").alias("issue"),
        F.lit("open").alias("resolution")).alias("c"))
    logs = errs.groupBy("product").agg(F.collect_list("c").alias("changeLogs"))
    doc = sites.join(rels, "product", "left").join(logs, "product", "left")
    return doc.select(F.to_json(F.struct(F.struct(
        F.col("product").alias("productCode"), F.concat(F.lit("Product "), F.col("product")).alias("productName"),
        "siteCodes", "changeLogs", "releases").alias("data"))).alias("json"))


@register("explode_availability", f"""
SELECT DISTINCT {_PRODUCT.format(t='varchar')} AS product, {_SITE.format(t='varchar')} AS site,
  {_MONTH.format(t='varchar')} AS month,
  'https://data/' || {_PRODUCT.format(t='varchar')} || '/' || {_SITE.format(t='varchar')} || '/' || {_MONTH.format(t='varchar')} AS url
FROM events
""")
def q_explode_availability(spark, sf_dir):
    return K.explode_availability(documents(spark, sf_dir))


@register("explode_files", f"""
SELECT {_PRODUCT.format(t='varchar')} AS product, {_REL} AS release, {_PKG} AS package,
  {_SITE.format(t='varchar')} AS site, {_MONTH.format(t='varchar')} AS month, 'f' || cast(event_id AS varchar) AS name, 'https://files/' || cast(event_id AS varchar) AS url,
  md5(cast(event_id AS varchar)) AS md5, event_id * 10 AS size
FROM events
""")
def q_explode_files(spark, sf_dir):
    return K.explode_files(documents(spark, sf_dir))


@register("issue_log", f"""
SELECT {_PRODUCT.format(t='varchar')} AS product, event_id AS id, {_SITE.format(t='varchar')} AS locationAffected,
  props AS issue
FROM events WHERE event_type = 'error'
""")
def q_issue_log(spark, sf_dir):
    return K.issue_log(documents(spark, sf_dir)).select("product", "id", "locationAffected", "issue")


# Bundles of the products whose numbers share their last digit.
BUNDLES_SQL = f"""
SELECT DISTINCT 'DP4.0000' || cast(user_id % 10 AS string) || '.001' AS product, {_PRODUCT.format(t='string')} AS member
FROM events WHERE user_id % 10 < 4
"""


@register("issue_log_bundle", f"""
WITH b AS ({BUNDLES_SQL.replace('AS string', 'AS varchar')})
SELECT b.product, b.member AS dataSubproduct, event_id AS id, {_SITE.format(t='varchar')} AS locationAffected, props AS issue
FROM events JOIN b ON b.member = {_PRODUCT.format(t='varchar')} WHERE event_type = 'error'
""")
def q_issue_log_bundle(spark, sf_dir):
    log = K.issue_log(documents(spark, sf_dir), bundles=shape(spark, sf_dir, BUNDLES_SQL))
    return log.select("product", "dataSubproduct", "id", "locationAffected", "issue")


POSITIONS_SQL = """
SELECT lpad(cast(l_suppkey % 5 AS string), 3, '0') || '.' || lpad(cast(10 * (1 + l_linenumber % 3) AS string), 3, '0')
         AS hv,
       cast(year(l_shipdate) AS string) || '-' || lpad(cast(month(l_shipdate) AS string), 2, '0') AS month
FROM lineitem
"""


@register("sensor_position_indices", f"""
WITH p AS ({POSITIONS_SQL.replace('AS string', 'AS varchar')})
SELECT DISTINCT substr(hv, 1, 3) AS HOR, substr(hv, 5, 3) AS VER FROM p WHERE month = (SELECT max(month) FROM p)
""")
def q_sensor_position_indices(spark, sf_dir):
    pos = shape(spark, sf_dir, POSITIONS_SQL).withColumnRenamed("hv", "HOR.VER")
    return K.sensor_position_indices(pos)


TABLE_TYPES_SQL = """
SELECT 'DP1.' || lpad(cast(10000 + p_size % 4 AS string), 5, '0') || '.001' AS productID,
       'tab_' || cast(p_partkey % 9 AS string) AS tableName, (p_partkey % 4) * 15 AS tableTMI
FROM part
"""


@register("time_indices", f"""
SELECT DISTINCT (p_partkey % 4) * 15 AS time_index FROM part
WHERE p_size % 4 = 1 AND (p_partkey % 4) * 15 <> 0
""")
def q_time_indices(spark, sf_dir):
    return K.time_indices(shape(spark, sf_dir, TABLE_TYPES_SQL), "DP1.10001.001")
