"""Checked queries for scans, stacking and sinks.

The store of ``suite.store`` is written from ``orders``/``customer``; the
oracle of a stacked table is the plain table it was written from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import manifest as M
from ..operators import schema as S
from ..operators import stack as ST
from ..plans import query as Q
from ..plans.stack import load_table, read_variables, stack_frame_files, stack_product, stack_store, stack_versions
from ..session import scratch_path, write_once
from ..sources import csv as C
from ..sources.listing import list_data_files, scan_manifest
from .flagship import FLAGSHIP_ORACLE, flagship, stacked_orders
from .registry import register
from .shapes import VERSIONS_SQL, shape
from .store import SITE_EXPR, STACKED_ORDERS_ORACLE, store_for

_YM = "cast(year(o_orderdate) + 25 AS string) || lpad(cast(month(o_orderdate) AS string), 2, '0')"


def _orders_view(df):
    return df.select("siteID", "o_orderkey", "o_totalprice", "o_orderstatus",
                     F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), "release")


@register("flagship_mean_price", FLAGSHIP_ORACLE)
def q_flagship(spark, sf_dir):
    return flagship(spark, sf_dir)


@register("stack_table", STACKED_ORDERS_ORACLE)
def q_stack_table(spark, sf_dir):
    return _orders_view(stacked_orders(spark, sf_dir))


@register("list_data_files", f"""
SELECT cast(sum(CASE WHEN m % 2 = 0 THEN 4 ELSE 2 END)
            + (SELECT count(DISTINCT {SITE_EXPR}) * 2 FROM customer) AS bigint) AS n_files
FROM (SELECT DISTINCT {SITE_EXPR} AS s, year(o_orderdate) AS y, month(o_orderdate) AS m
      FROM orders JOIN customer ON o_custkey = c_custkey) t
""")
def q_list_data_files(spark, sf_dir):
    # every site-month has a data and a variables file per publication, plus
    # two customer files per site
    files = list_data_files(spark, store_for(spark, sf_dir))
    return files.agg(F.count(F.lit(1)).cast("bigint").alias("n_files"))


@register("scan_csv", f"""
SELECT o_orderkey, 'new' AS version FROM orders
UNION ALL
SELECT o_orderkey, 'old' FROM orders WHERE month(o_orderdate) % 2 = 0
""")
def q_scan_csv(spark, sf_dir):
    man = scan_manifest(spark, store_for(spark, sf_dir)).filter(F.col("table") == "ord_orders")
    raw = C.scan_csv(spark, man)
    day = F.substring(F.regexp_extract(F.col("file"), r"([0-9]{8})T[0-9]{6}Z\.csv$", 1), 7, 2)
    return raw.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                      F.when(day == "28", "new").otherwise("old").alias("version"))


@register("superset_schema", """
SELECT * FROM (VALUES (1, 'o_orderkey'), (2, 'o_custkey'), (3, 'o_orderstatus'), (4, 'o_totalprice'),
  (5, 'o_orderdate'), (6, 'o_orderpriority'), (7, 'remarks')) t(position, field)
WHERE (SELECT count(*) FROM orders) > 0
""")
def q_superset_schema(spark, sf_dir):
    man = scan_manifest(spark, store_for(spark, sf_dir)).filter(F.col("table") == "ord_orders")
    names = C.superset_header(spark, man)
    return spark.createDataFrame(list(enumerate(names, 1)), "position int, field string")


@register("with_provenance", f"""
SELECT o_orderkey, {_YM} || '28T120000Z' AS publicationDate,
  CASE WHEN year(o_orderdate) >= 2000 THEN 'PROVISIONAL' ELSE 'RELEASE-2024' END AS release
FROM orders
""")
def q_with_provenance(spark, sf_dir):
    return stacked_orders(spark, sf_dir).select("o_orderkey", "publicationDate", "release")


@register("with_position", f"""
SELECT 'D0' || cast(1 + c_nationkey % 2 AS string) AS domainID, {SITE_EXPR} AS siteID, o_orderkey
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_with_position(spark, sf_dir):
    return stacked_orders(spark, sf_dir).select("domainID", "siteID", "o_orderkey")


@register("guard_single_release", """
SELECT cast(1 AS bigint) AS n_releases, 'RELEASE-2024' AS releases,
       max(CASE WHEN year(o_orderdate) >= 2000 THEN 1 ELSE 0 END) AS has_provisional
FROM orders
""")
def q_guard_single_release(spark, sf_dir):
    return ST.release_check(ST.guard_single_release(stacked_orders(spark, sf_dir)))


@register("stack_product", f"""
SELECT 'ord_customers' AS table_name, {SITE_EXPR} AS siteID, c_custkey AS id, c_acctbal AS value FROM customer
UNION ALL
SELECT 'ord_orders', {SITE_EXPR}, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL
SELECT 'variables_00001', NULL, 11, NULL WHERE (SELECT count(*) FROM orders) > 0
""")
def q_stack_product(spark, sf_dir):
    current = write_once(M.as_of_publication(scan_manifest(spark, store_for(spark, sf_dir)), None), "manifest")
    tables = stack_product(spark, current)
    parts = [
        df.select(F.lit(name).alias("table_name"), "siteID", F.col(key).cast("bigint").alias("id"), F.col(value).cast("double").alias("value"))
        for name, key, value in (("ord_customers", "c_custkey", "c_acctbal"), ("ord_orders", "o_orderkey", "o_totalprice"))
        for df in [tables[name]]
    ]
    rest = {k: df for k, df in tables.items() if k not in ("ord_customers", "ord_orders")}
    for name, df in rest.items():
        parts.append(df.agg(F.lit(name).alias("table_name"), F.lit(None).cast("string").alias("siteID"),
                            F.count(F.lit(1)).cast("bigint").alias("id"), F.lit(None).cast("double").alias("value")))
    return ST.union_evolving(parts)


_ASOF = "20230630"


@register("stack_store", f"""
SELECT o_orderkey,
  CASE WHEN cast({_YM} || '28' AS bigint) <= {_ASOF} THEN o_totalprice ELSE o_totalprice + 1000 END AS o_totalprice
FROM orders
WHERE cast({_YM} || '28' AS bigint) <= {_ASOF}
   OR (month(o_orderdate) % 2 = 0 AND cast({_YM} || '05' AS bigint) <= {_ASOF})
""")
def q_stack_store(spark, sf_dir):
    tables = stack_store(spark, store_for(spark, sf_dir), pubdate="2023-06-30", package="expanded", tables=["ord_orders"])
    return tables["ord_orders"].select("o_orderkey", "o_totalprice")


@register("load_table", f"""
SELECT o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE {SITE_EXPR} = 'ST01' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
""")
def q_load_table(spark, sf_dir):
    df = load_table(spark, store_for(spark, sf_dir), "ord_orders", sites=["ST01"], start="1996-01",
                    end="1997-12", package="expanded")
    return df.select("o_orderkey", "o_totalprice")


@register("write_stacked", STACKED_ORDERS_ORACLE)
def q_write_stacked(spark, sf_dir):
    out = scratch_path(spark, "stacked")
    orders = stacked_orders(spark, sf_dir)
    paths = ST.write_stacked({"ord_orders": orders}, out, "parquet")
    return _orders_view(spark.read.parquet(paths["ord_orders"]))


@register("write_stacked_csv", """
SELECT o_orderkey, o_totalprice,
  CASE WHEN o_orderkey % 97 = 0 AND year(o_orderdate) <> 1997
       THEN 'first line' || chr(10) || 'said "late", then left' END AS remarks
FROM orders
""")
def q_write_stacked_csv(spark, sf_dir):
    out = scratch_path(spark, "stacked-csv")
    orders = stacked_orders(spark, sf_dir)
    paths = ST.write_stacked({"ord_orders": orders}, out, "csv")
    back = spark.read.options(**C.CSV_OPTIONS).csv(paths["ord_orders"])
    return back.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                       F.col("o_totalprice").cast("double").alias("o_totalprice"),
                       F.nullif(F.col("remarks"), F.lit("")).alias("remarks"))


@register("geocsv_header", """
SELECT * FROM (VALUES
 (1, '# dataset: GeoCSV 2.0'), (2, '# delimiter: ","'),
 (3, '# field_long_name: domainID, siteID, order key, customer key, order status, total price, order date, priority, remarks, publicationDate, release'),
 (4, '# field_type: string, string, integer, integer, string, float, string, string, string, string, string'),
 (5, '# field_unit: unitless, unitless, number, number, unitless, dollar, unitless, unitless, unitless, unitless, unitless')) t(line_no, line)
WHERE (SELECT count(*) FROM orders) > 0
""")
def q_geocsv_header(spark, sf_dir):
    orders = stacked_orders(spark, sf_dir)
    man = M.as_of_publication(scan_manifest(spark, store_for(spark, sf_dir)), None)
    variables = read_variables(spark, man)
    return S.geocsv_lines(orders, variables)


@register("write_geocsv", """
SELECT cast(c_custkey AS varchar) || ',' || c_mktsegment AS line FROM customer
UNION ALL SELECT 'c_custkey,c_mktsegment'
UNION ALL SELECT * FROM (VALUES ('# dataset: GeoCSV 2.0'), ('# delimiter: ","'), ('# title: customers'),
  ('# field_long_name: customer key, segment'), ('# field_type: integer, string'), ('# field_unit: number, unitless')) t
""")
def q_write_geocsv(spark, sf_dir):
    man = M.as_of_publication(scan_manifest(spark, store_for(spark, sf_dir)), None)
    rows = shape(spark, sf_dir, "SELECT c_custkey, c_mktsegment FROM customer")
    path = S.write_geocsv(rows, read_variables(spark, man), scratch_path(spark, "geocsv"), title="customers")
    return spark.read.text(path).withColumnRenamed("value", "line")


@register("dedupe_latest_by_id", f"""
WITH v AS ({VERSIONS_SQL}),
u AS (SELECT DISTINCT * FROM v)
SELECT srfID, lastUpdateDateTime, tiebreak FROM u
QUALIFY row_number() OVER (PARTITION BY srfID ORDER BY lastUpdateDateTime DESC, tiebreak ASC) = 1
""")
def q_dedupe_latest_by_id(spark, sf_dir):
    v = shape(spark, sf_dir, VERSIONS_SQL)
    out = ST.dedupe_latest_by_id(v, tiebreak=["tiebreak"])
    return out.select("srfID", "lastUpdateDateTime", "tiebreak")


@register("dedupe_latest_keep_ties", f"""
WITH v AS ({VERSIONS_SQL}),
u AS (SELECT DISTINCT * FROM v)
SELECT srfID, lastUpdateDateTime, tiebreak FROM u
QUALIFY rank() OVER (PARTITION BY srfID ORDER BY lastUpdateDateTime DESC) = 1
""")
def q_dedupe_latest_keep_ties(spark, sf_dir):
    v = shape(spark, sf_dir, VERSIONS_SQL)
    out = ST.dedupe_latest_by_id(v, keep_ties=True)
    return out.select("srfID", "lastUpdateDateTime", "tiebreak")


@register("union_evolving", """
SELECT event_id, cast(user_id AS varchar) AS user_key, value, NULL AS props FROM events WHERE event_id % 2 = 0
UNION ALL
SELECT event_id, event_type, NULL, props FROM events WHERE event_id % 2 = 1
""")
def q_union_evolving(spark, sf_dir):
    ev = shape(spark, sf_dir, "SELECT * FROM events")
    a = ev.filter("event_id % 2 = 0").select("event_id", F.col("user_id").alias("user_key"), "value")
    b = ev.filter("event_id % 2 = 1").select("event_id", F.col("event_type").alias("user_key"), "props")
    return ST.union_evolving([a, b])


# Rows of the chosen files, and of the variables files beside them the newest
# stamp, the stamp of each content's newest path, and whether contents differ.
@register("query_files", f"""
SELECT cast(count(*) AS bigint) AS n_files, max(stamp) AS newest_stamp, cast(1 AS bigint) AS n_contents,
       max(stamp) AS content_stamps, false AS several_versions
FROM (SELECT cast(year(o_orderdate) + 25 AS string) || lpad(cast(month(o_orderdate) AS string), 2, '0') || '28T120000Z' AS stamp
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE {SITE_EXPR} = 'ST00' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01') t
""")
def q_query_files(spark, sf_dir):
    res = Q.query_files(scan_manifest(spark, store_for(spark, sf_dir)), sites=["ST00"], start="1997-01",
                        end="1997-12", package="basic", table="ord_orders", metadata=False)
    files = M.as_of_publication(res["files"], None)
    # rows of the chosen files: read them to count the orders they hold
    data = C.scan_csv(spark, files).agg(F.count(F.lit(1)).cast("bigint").alias("n_files"))
    stamp = F.regexp_extract("path", r"variables\.([0-9]{8}T[0-9]{6}Z)\.csv$", 1)
    newest = res["newest_variables"].agg(F.max(stamp).alias("newest_stamp"))
    contents = res["variables_by_md5"].agg(
        F.count(F.lit(1)).cast("bigint").alias("n_contents"), F.concat_ws(",", F.sort_array(F.collect_set(stamp))).alias("content_stamps")
    )
    # one row each, put side by side
    whole = data
    for part in (newest, contents, res["versions"]):
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole.agg(*(F.max(c).alias(c) for c in whole.columns))


# Provisional files stay out: their months fall back to the release before.
@register("dataset_query", f"""
SELECT o_orderkey, o_totalprice + CASE WHEN year(o_orderdate) >= 2000 THEN 1000 ELSE 0 END AS o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE {SITE_EXPR} = 'ST01' AND o_orderstatus = 'F' AND (year(o_orderdate) < 2000 OR month(o_orderdate) % 2 = 0)
""")
def q_dataset_query(spark, sf_dir):
    df = Q.dataset_query(spark, scan_manifest(spark, store_for(spark, sf_dir)), table="ord_orders",
                         sites=["ST01"], package="expanded")
    return df.filter(F.col("o_orderstatus") == "F") \
        .select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                F.col("o_totalprice").cast("double").alias("o_totalprice"))


@register("events_by_type", "SELECT event_id FROM events WHERE event_type = 'click'")
def q_events_by_type(spark, sf_dir):
    return Q.events_by_type(shape(spark, sf_dir, "SELECT * FROM events"), "click", "event_type").select("event_id")


@register("latest_event_site", """
SELECT 'ST' || cast(user_id % 7 AS varchar) AS site, strftime(ts, '%Y-%m') AS month FROM events
ORDER BY ts DESC, 'ST' || cast(user_id % 7 AS varchar) DESC LIMIT 1
""")
def q_latest_event_site(spark, sf_dir):
    rows = shape(spark, sf_dir, "SELECT 'ST' || cast(user_id % 7 AS string) AS siteID, ts AS endDate FROM events")
    return Q.latest_event_site(rows)


@register("filter_files", f"""
SELECT 'ord_orders' AS table_name, cast(count(*) AS bigint) AS n_files FROM (
  SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE {SITE_EXPR} = 'ST00' AND year(o_orderdate) = 1996) t, (VALUES (1), (2)) v(n) WHERE n = 1 OR m % 2 = 0
""")
def q_filter_files(spark, sf_dir):
    man = Q.filter_files(scan_manifest(spark, store_for(spark, sf_dir)), sites=["ST00"], start="1996-01", end="1996-12",
                         table="ord_orders", metadata=False)
    return man.groupBy(F.col("table").alias("table_name")).agg(F.count(F.lit(1)).cast("bigint").alias("n_files"))


@register("scan_csv_inferred", """
SELECT c_custkey, c_acctbal, c_name FROM customer UNION ALL SELECT c_custkey, c_acctbal + 500, c_name FROM customer
""")
def q_scan_csv_inferred(spark, sf_dir):
    man = scan_manifest(spark, store_for(spark, sf_dir)).filter(F.col("table") == "ord_customers")
    return C.scan_csv_inferred(spark, man).select("c_custkey", "c_acctbal", "c_name")


@register("read_versions", STACKED_ORDERS_ORACLE)
def q_read_versions(spark, sf_dir):
    man = M.as_of_publication(scan_manifest(spark, store_for(spark, sf_dir)), None)
    return _orders_view(stack_versions(spark, man, "ord_orders", package="expanded"))


@register("stack_frame_files", """
SELECT c_custkey, c_acctbal, c_mktsegment FROM customer UNION ALL SELECT c_custkey, c_acctbal + 500, c_mktsegment FROM customer
""")
def q_stack_frame_files(spark, sf_dir):
    man = scan_manifest(spark, store_for(spark, sf_dir))
    files = man.filter(F.col("table") == "ord_customers")
    variables = read_variables(spark, M.as_of_publication(man, None))
    frames = variables.filter(F.col("table") == "ord_customers").withColumn("table", F.lit("module2"))
    return stack_frame_files(spark, files, frames, "module").select("c_custkey", "c_acctbal", "c_mktsegment")


# Up to 997 sites; their order is proved from the bounds of the written files
# and the rows in each.
_MANY_SITES_SQL = "SELECT 'D' || lpad(cast(c_custkey % 997 % 20 AS string), 2, '0') AS domainID, 'S' || lpad(cast(c_custkey % 997 AS string), 3, '0') AS siteID FROM customer"


@register("order_stacked", f"""
SELECT siteID, cast(count(*) AS bigint) AS n_rows, cast(0 AS bigint) AS n_faults FROM ({_MANY_SITES_SQL}) t GROUP BY siteID
""")
def q_order_stacked(spark, sf_dir):
    path = scratch_path(spark, "ordered")
    ST.order_stacked(shape(spark, sf_dir, _MANY_SITES_SQL)).write.parquet(path)
    faults = ST.order_faults(spark, path, ["domainID", "siteID"]).select("n_faults").scalar()
    return spark.read.parquet(path).groupBy("siteID").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_faults", faults)
