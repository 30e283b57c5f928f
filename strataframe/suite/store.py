"""A published-file store written from the driver's ``orders``/``customer``
tables, for the stacking queries.

Layout: one folder per (site, month, publication, release) holding that
site-month's ``ord_orders`` CSV and its ``variables`` file; site-all
``ord_customers`` files in their own folders.  Even months have an older
publication with wrong prices, so only "latest publication" gives the
right answer.  Header order drifts in 1996 and one column is missing in
1997; some remarks hold quotes, commas and newlines; nulls are ``NA``.

Files are written on the executors, one task per file group
(``applyInPandas`` keyed by file path); a file is one month (for customers:
one publication) of a site, and a site has a bounded number of customers.
"""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .shapes import register_tables

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority", "remarks"]
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
# The header variants of the store (drift over the years).
HEADERS = {
    "A": ORDER_COLUMNS,
    "B": ["o_orderpriority", "o_orderkey", "o_orderdate", "o_custkey", "remarks", "o_totalprice",
          "o_orderstatus"],
    "C": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "K": CUSTOMER_COLUMNS,
}
# The store's declared fields (table, field, type, format).
VARIABLES_ROWS = [
    ("ord_orders", "o_orderkey", "order key", "unsigned integer", "number", "basic", "integer", "Y"),
    ("ord_orders", "o_custkey", "customer key", "unsigned integer", "number", "basic", "integer", "N"),
    ("ord_orders", "o_orderstatus", "order status", "string", "", "basic", "asIs", "N"),
    ("ord_orders", "o_totalprice", "total price", "real", "dollar", "basic", "*.##", "N"),
    ("ord_orders", "o_orderdate", "order date", "dateTime", "", "basic", "yyyy-MM-dd'T'HH:mm:ss'Z'(floor)", "N"),
    ("ord_orders", "o_orderpriority", "priority", "string", "", "basic", "asIs", "N"),
    ("ord_orders", "remarks", "remarks", "string", "", "expanded", "asIs", "N"),
    ("ord_customers", "c_custkey", "customer key", "unsigned integer", "number", "basic", "integer", "Y"),
    ("ord_customers", "c_name", "name", "string", "", "basic", "asIs", "N"),
    ("ord_customers", "c_acctbal", "account balance", "real", "dollar", "basic", "*.##", "N"),
    ("ord_customers", "c_mktsegment", "segment", "string", "", "basic", "asIs", "N"),
]
VARIABLES_HEADER = ["table", "fieldName", "description", "dataType", "units", "downloadPkg",
                    "pubFormat", "primaryKey", "categoricalCodeName"]

# Two sites for each ten thousand customer keys, so that sites grow with the
# data and a file stays small: ST00, ST01, ... ST99, SU00, ...
_SITE_NO = "(2 * cast(floor(c_custkey / 10000) AS bigint) + c_nationkey % 2)"
SITE_EXPR = (
    f"chr(cast(65 + (18 + floor({_SITE_NO} / 2600)) % 26 AS int)) || chr(cast(65 + (19 + floor({_SITE_NO} / 100)) % 26 AS int)) "
    f"|| lpad(cast({_SITE_NO} % 100 AS string), 2, '0')"
)
DOMAIN_EXPR = "'D0' || cast(1 + c_nationkey % 2 AS string)"

ORDERS_SQL = f"""
SELECT
  {DOMAIN_EXPR} AS dom, {SITE_EXPR} AS site,
  cast(year(o_orderdate) AS string) || '-' || lpad(cast(month(o_orderdate) AS string), 2, '0') AS mon,
  year(o_orderdate) AS yr, month(o_orderdate) AS mo,
  o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  CASE WHEN o_orderkey % 97 = 0 THEN 'first line' || chr(10) || 'said "late", then left'
       WHEN o_orderkey % 89 = 0 THEN '' END AS remarks
FROM orders JOIN customer ON o_custkey = c_custkey
"""

# The oracle for the stacked orders: the latest publication of every
# site-month is the plain table.
STACKED_ORDERS_ORACLE = f"""
SELECT {SITE_EXPR} AS siteID, o_orderkey, o_totalprice, o_orderstatus,
  cast(o_orderdate AS timestamp) AS o_orderdate,
  CASE WHEN year(o_orderdate) >= 2000 THEN 'PROVISIONAL' ELSE 'RELEASE-2024' END AS release
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def _write_text(path: str, text: str) -> None:
    if path.startswith("file:"):
        local = path[len("file://"):] if path.startswith("file://") else path[len("file:"):]
        import os

        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "w", encoding="utf-8", newline="") as fh:
            fh.write(text)
        return
    from pyarrow import fs as pafs

    filesystem, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(inner) as out:
        out.write(text.encode("utf-8"))


def _csv_text(pdf: pd.DataFrame, cols: list[str]) -> str:
    buf = io.StringIO()
    pdf[cols].to_csv(buf, index=False, na_rep="NA", quoting=csv.QUOTE_MINIMAL, lineterminator="\n")
    return buf.getvalue()


def _write_group(pdf: pd.DataFrame) -> pd.DataFrame:
    path = pdf["path"].iloc[0]
    cols = HEADERS[pdf["variant"].iloc[0]]
    body = pdf.copy()
    if "o_orderdate" in body.columns:
        body["o_orderdate"] = pd.to_datetime(body["o_orderdate"]).dt.strftime("%Y-%m-%dT%H:%M:%SZ")
    _write_text(path, _csv_text(body, cols))
    var_path = pdf["var_path"].iloc[0]
    if isinstance(var_path, str) and var_path:
        vrows = pd.DataFrame([list(r) + [""] for r in VARIABLES_ROWS], columns=VARIABLES_HEADER)
        _write_text(var_path, _csv_text(vrows, VARIABLES_HEADER))
    return pd.DataFrame({"path": [path], "rows": [len(pdf)]})


def _uri(root: str) -> str:
    return root if "://" in root or root.startswith("file:") else "file://" + root


def write_store(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Write the store for the tables of ``sf_dir``; returns its root."""
    register_tables(spark, sf_dir)
    root = _uri(root or scratch_path(spark, "store"))
    base = spark.sql(ORDERS_SQL)
    prefix = F.concat(F.lit("OBS."), F.col("dom"), F.lit("."), F.col("site"), F.lit(".DP1.00001.001."))

    def version(df: DataFrame, stamp_day: str, rel: F.Column, price_shift: float) -> DataFrame:
        stamp = F.concat((F.col("yr") + 25).cast("string"), F.lpad(F.col("mo").cast("string"), 2, "0"),
                         F.lit(stamp_day + "T120000Z"))
        folder = F.concat(F.lit(root + "/"), prefix, F.col("mon"), F.lit(".basic."), stamp, F.lit("."), rel)
        name = F.concat(prefix, F.lit("ord_orders."), F.col("mon"), F.lit(".basic."), stamp, F.lit(".csv"))
        vname = F.concat(prefix, F.lit("variables."), stamp, F.lit(".csv"))
        variant = F.when(F.col("yr") == 1996, "B").when(F.col("yr") == 1997, "C").otherwise("A")
        return df.select(
            F.concat(folder, F.lit("/"), name).alias("path"),
            F.concat(folder, F.lit("/"), vname).alias("var_path"),
            variant.alias("variant"),
            "o_orderkey", "o_custkey", "o_orderstatus",
            (F.col("o_totalprice") + F.lit(price_shift)).alias("o_totalprice"),
            "o_orderdate", "o_orderpriority", "remarks",
        )

    new = version(base, "28", F.when(F.col("yr") >= 2000, "PROVISIONAL").otherwise("RELEASE-2024"), 0.0)
    old = version(base.filter(F.col("mo") % 2 == 0), "05", F.lit("RELEASE-2023"), 1000.0)
    orders = new.unionByName(old)
    out_schema = "path string, rows long"
    orders.groupBy("path").applyInPandas(_write_group, out_schema).write.format("noop").mode("overwrite").save()

    cust = spark.sql(f"""
      SELECT {DOMAIN_EXPR} AS dom, {SITE_EXPR} AS site, c_custkey, c_name, c_acctbal, c_mktsegment
      FROM customer""")

    def cust_version(stamp: str, shift: float) -> DataFrame:
        folder = F.concat(F.lit(root + "/"), prefix, F.lit(stamp + ".RELEASE-2024"))
        name = F.concat(prefix, F.lit("ord_customers.basic." + stamp + ".csv"))
        return cust.select(
            F.concat(folder, F.lit("/"), name).alias("path"),
            F.lit("").alias("var_path"),
            F.lit("K").alias("variant"),
            "c_custkey", "c_name", (F.col("c_acctbal") + F.lit(shift)).alias("c_acctbal"), "c_mktsegment",
        )

    custs = cust_version("20240101T000000Z", 0.0).unionByName(cust_version("20230101T000000Z", 500.0))
    custs.groupBy("path").applyInPandas(_write_group, out_schema).write.format("noop").mode("overwrite").save()
    return root


_STORES: dict[tuple, str] = {}


def store_for(spark: SparkSession, sf_dir: str) -> str:
    """The store of ``sf_dir``, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        _STORES[key] = write_store(spark, sf_dir)
    return _STORES[key]
