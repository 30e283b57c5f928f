"""Checked queries on the product store: versions as data (T5), a product's
metadata tables (T15), packages as of a date (T16), per-sample files (T17), and
the sorted and committed sinks (T9, T19)."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import stack as ST
from ..plans.stack import stack_frames, stack_product, stack_store, stack_versions
from ..session import scratch_path, write_once
from ..sources.listing import scan_manifest
from .metadata_suite import ADDED, added_fields
from .product_store import CODES, FRAME_VARIABLES, README, ROWS_SQL, VALIDATION, VERSIONS, product_store
from .registry import register
from .shapes import shape

P_CTE = f"WITH r AS ({ROWS_SQL})"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ``amount`` is text because one version says so, and keeps its digits; ``moment``
# is read by each file's own version; ``grade`` is there since it was declared.
@register("stack_versions", P_CTE + """
SELECT site AS siteID, k, amount, CAST(replace(replace(moment, 'T', ' '), 'Z', CASE WHEN length(moment) = 17 THEN ':00' ELSE '' END) AS TIMESTAMP) AS moment,
  CASE WHEN yr > 1997 THEN grade END AS grade
FROM r
""")
def q_stack_versions(spark, sf_dir):
    man = scan_manifest(spark, product_store(spark, sf_dir) + "/main").filter("table IS NULL OR package = 'basic'")
    out = stack_versions(spark, write_once(man, "manifest"), "prd_both")
    return out.select("siteID", "k", "amount", F.col("moment").cast("timestamp_ntz").alias("moment"), "grade")


def _declared(version: str) -> list[tuple[str, str]]:
    return [tuple(line.split(",")[:2]) for line in VERSIONS[version][1:]]


def _variables_sql() -> str:
    """The newest version's rows, each stacked table's with what stacking adds
    (no table has positions), and the review table's, which the file lacks."""
    stacked = ("prd_both", "prd_basic", "prd_expanded")
    provenance = [n for n, _, _ in ADDED if n in ("publicationDate", "release")]
    rows = [r for r in _declared("late")] + [("science_review_flags", f) for f in ("srfID", "lastUpdateDateTime")]
    rows += [(t, n) for t in (*stacked, "science_review_flags") for n in provenance]
    return ", ".join(f"('variables_00002', '{t}', '{f}')" for t, f in rows)


_ISSUES = [{"id": 1, "issue": "drift"}, {"id": 2, "issue": "gap"}]


@register("stack_product_metadata", P_CTE + f"""
SELECT * FROM (VALUES {_variables_sql()},
  {", ".join("('validation_00002', '%s', '%s')" % tuple(x.split(",")[:2]) for x in VALIDATION[1:])},
  {", ".join("('categoricalCodes_00002', '%s', '%s')" % tuple(x.split(",")[:2]) for x in CODES[1:])},
  {", ".join("('readme_00002', '%s', NULL)" % x for x in README)},
  {", ".join("('issueLog_00002', '%s', '%s')" % (x["id"], x["issue"]) for x in _ISSUES)}) t(output, a, b)
WHERE (SELECT max(yr) FROM r) > 1997
UNION ALL SELECT 'science_review_flags_00002', 'F' || cast(k AS varchar), max(stamp) FROM r WHERE k % 50 = 0 GROUP BY k
UNION ALL SELECT output, site, cast(count(*) AS varchar) FROM r, (VALUES ('prd_both'), ('prd_basic'), ('prd_expanded')) t(output) GROUP BY output, site
""")
def q_stack_product_metadata(spark, sf_dir):
    import json

    extra = [("science_review_flags", f, "string") for f in ("srfID", "lastUpdateDateTime")] + [("sensor_positions", "x", "string")]
    catalogue = [json.dumps({"data": {"productCode": f"DP1.{code}.001", "changeLogs": _ISSUES}}) for code in ("00002", "00009")]
    man = scan_manifest(spark, product_store(spark, sf_dir) + "/main").filter("table IS NULL OR table <> 'prd_both' OR package = 'expanded'")
    tables = stack_product(
        spark, write_once(man, "manifest"), package="expanded", added_fields=added_fields(spark),
        metadata_variables=spark.createDataFrame(extra, "`table` string, fieldName string, dataType string"),
        catalogue=spark.createDataFrame([(c,) for c in catalogue], "json string"),
    )
    shown = {
        "variables_00002": ("table", "fieldName"), "validation_00002": ("table", "fieldName"), "categoricalCodes_00002": ("name", "code"),
        "readme_00002": ("value", None), "issueLog_00002": ("id", "issue"), "science_review_flags_00002": ("srfID", "lastUpdateDateTime"),
    }
    parts = []
    for name, df in tables.items():
        if name in shown:
            a, b = shown[name]
            parts.append(df.select(F.lit(name).alias("output"), F.col(a).cast("string").alias("a"), (F.lit(None) if b is None else F.col(b)).cast("string").alias("b")))
        else:
            parts.append(df.groupBy(F.col("siteID").alias("a")).agg(F.count("k").cast("string").alias("b")).select(F.lit(name).alias("output"), "a", "b"))
    return _union(parts)


# As of 2022 the newest variables file says that prd_expanded is basic, and the
# files of later years are not there yet.
_LATE, _EARLY = "2099-01-01", "2022-12-31"


@register("stack_store_packages", P_CTE + f"""
, asked AS (SELECT * FROM (VALUES ('{_LATE}', 'basic'), ('{_LATE}', 'expanded'), ('{_EARLY}', 'basic')) v(pubdate, package))
, tables AS (SELECT * FROM (VALUES ('prd_both'), ('prd_basic'), ('prd_expanded')) v(table_name))
SELECT pubdate, package, table_name, cast(count(*) AS bigint) AS n_rows, cast(sum(k) AS bigint) AS sum_k,
  CASE WHEN table_name <> 'prd_both' THEN '' WHEN package = 'expanded' THEN 'remark' ELSE 'no remark' END AS fields
FROM asked, tables, r
WHERE stamp <= replace(pubdate, '-', '') || 'T000000Z' AND (table_name <> 'prd_expanded' OR package = 'expanded' OR pubdate = '{_EARLY}')
GROUP BY pubdate, package, table_name
UNION ALL SELECT pubdate, package, 'missing: prd_absent', 0, 0, '' FROM asked WHERE (SELECT count(*) FROM r) > 0
""")
def q_stack_store_packages(spark, sf_dir):
    root, parts = product_store(spark, sf_dir) + "/main", []
    for pubdate, package in ((_LATE, "basic"), (_LATE, "expanded"), (_EARLY, "basic")):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")  # of the missing table, which is a row here
            tables = stack_store(spark, root, pubdate=pubdate, package=package, tables=["prd_both", "prd_basic", "prd_expanded"])
        for name in ("prd_both", "prd_basic", "prd_expanded"):
            if name in tables:
                fields = "" if name != "prd_both" else "remark" if "remark" in tables[name].columns else "no remark"
                parts.append(tables[name].agg(F.count("k").alias("n_rows"), F.sum("k").alias("sum_k")).select(
                    F.lit(pubdate).alias("pubdate"), F.lit(package).alias("package"), F.lit(name).alias("table_name"), "n_rows", "sum_k", F.lit(fields).alias("fields")))
        parts.append(tables["missing_tables"].select(
            F.lit(pubdate).alias("pubdate"), F.lit(package).alias("package"), F.concat(F.lit("missing: "), "table").alias("table_name"),
            F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("sum_k"), F.lit("").alias("fields")))
    return _union(parts)


# Three tables of two products: one fits its module, one the module's second
# version, one none and is inferred.
@register("stack_frames", P_CTE + """
SELECT 'mcc_soilPerSampleTaxonomy_ITS' AS table_name, k, cast(c7 AS varchar) AS value, 'bigint' AS type FROM r WHERE c7 < 3
UNION ALL SELECT 'mcc_soilPerSampleTaxonomy_16S', k, cast(cast(amount AS double) AS varchar), 'double' FROM r WHERE c7 >= 3
UNION ALL SELECT 'rea_conductivityRawData', k, CASE WHEN k % 2 = 0 THEN 'warm' ELSE 'cold' END, 'string' FROM r WHERE c7 = 1
""")
def q_stack_frames(spark, sf_dir):
    fields = spark.createDataFrame(FRAME_VARIABLES, "`table` string, fieldName string, dataType string, pubFormat string")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # of the inferred table
        tables = stack_frames(spark, scan_manifest(spark, product_store(spark, sf_dir) + "/frames"), fields, prefix="OBS.")
    parts = []
    for name, df in tables.items():
        value = "abundance" if name.startswith("mcc") else "temperature"
        kind = df.schema[value].dataType.simpleString()
        parts.append(df.select(F.lit(name).alias("table_name"), F.col("k").cast("long").alias("k"), F.col(value).cast("string").alias("value"), F.lit(kind).alias("type")))
    return _union(parts)


_SITES_SQL = "SELECT 'D' || lpad(cast(c_custkey % 997 % 20 AS string), 2, '0') AS domainID, 'S' || lpad(cast(c_custkey % 997 AS string), 3, '0') AS siteID, c_custkey, c_acctbal FROM customer"


# The order of up to 997 sites, proved from the bounds of the files and the rows
# in each; the rows themselves come back whole.
@register("write_sorted", f"""
SELECT siteID, domainID, c_custkey, c_acctbal, cast((SELECT count(*) FROM customer) AS bigint) AS n_rows, cast(0 AS bigint) AS n_faults FROM ({_SITES_SQL}) s
""")
def q_write_sorted(spark, sf_dir):
    keys = ["domainID", "siteID"]
    path = ST.write_sorted(shape(spark, sf_dir, _SITES_SQL), keys, scratch_path(spark, "sorted"), max_rows=1000)
    proof = ST.order_faults(spark, path, keys)
    rows = spark.read.parquet(path)
    return rows.withColumn("n_rows", proof.select("n_rows").scalar()).withColumn("n_faults", proof.select("n_faults").scalar())


@register("write_committed", """
SELECT 'orders' AS table_name, cast(2 AS bigint) AS number, o_orderkey AS k, o_totalprice + 1 AS v FROM orders
UNION ALL SELECT 'customers', 2, c_custkey, c_acctbal FROM customer
""")
def q_write_committed(spark, sf_dir):
    orders = shape(spark, sf_dir, "SELECT o_orderkey AS k, o_totalprice AS v FROM orders")
    customers = shape(spark, sf_dir, "SELECT c_custkey AS k, c_acctbal AS v FROM customer")
    out = scratch_path(spark, "committed")
    ST.write_committed({"orders": orders}, out, "first")
    changed = {"orders": orders.withColumn("v", F.col("v") + 1), "customers": customers}
    for _ in range(2):  # the second time is a replay
        number = ST.write_committed(changed, out, "second", max_rows=10_000)
    return _union([df.withColumn("table_name", F.lit(name)).withColumn("number", F.lit(number).cast("long")) for name, df in ST.read_committed(spark, out).items()])
