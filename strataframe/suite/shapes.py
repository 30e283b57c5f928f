"""Input shapes built from the driver's tables.

Each shape is one SQL text in the subset that Spark SQL and DuckDB read the
same way (``||``, ``lpad``, ``cast(... AS string)``, ``%`` on non-negative
integers, ``year``/``month``/``day``, ``CASE``, ``md5``), so the Spark query
and its DuckDB oracle start from identical rows.  Shapes carry, next to the
raw input, the *truth* columns known from construction; oracles read those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Temp views over the parquet tables (lazy, nothing is read)."""
    prepare(spark)
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def shape(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    register_tables(spark, sf_dir)
    return spark.sql(sql)


_WRITTEN: dict[tuple, str] = {}


def written_shape(spark: SparkSession, sf_dir: str, sql: str, label: str) -> DataFrame:
    """The shape written once per application as Parquet under the shared folder
    and read back: a real scan source (as a file listing would be) with the
    lineage cut, instead of a long expression tree in every plan."""
    from ..session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir, label)
    path = _WRITTEN.get(key)
    if path is None:
        path = scratch_path(spark, f"shape-{label}")
        shape(spark, sf_dir, sql).write.mode("overwrite").parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(path)


# One published file per order.  Identity parts:
#   domain/site from the customer's nation, product from the customer,
#   month from the order date, package from the priority, release from the
#   order key, publication stamp from date and key (so site-months get
#   several publications and some equal stamps), sensor position for urgent
#   and high priority orders, metadata files for a few keys.
_PARTS = """
SELECT
  o.o_orderkey AS file_id,
  o.o_orderstatus AS status,
  'D' || lpad(cast(c.c_nationkey % 20 + 1 AS string), 2, '0') AS dom,
  'ST' || lpad(cast(c.c_nationkey AS string), 2, '0') AS st,
  'LAB' || cast(o.o_custkey % 4 AS string) AS lab_name,
  'DP1.0000' || cast(1 + o.o_custkey % 3 AS string) || '.001' AS prod,
  cast(year(o.o_orderdate) AS string) || '-' || lpad(cast(month(o.o_orderdate) AS string), 2, '0') AS mon,
  CASE WHEN o.o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'expanded' ELSE 'basic' END AS pkg,
  cast(year(o.o_orderdate) + 25 + o.o_orderkey % 2 AS string)
    || lpad(cast(month(o.o_orderdate) AS string), 2, '0')
    || lpad(cast(1 + o.o_orderkey % 28 AS string), 2, '0') || 'T'
    || lpad(cast(o.o_orderkey % 24 AS string), 2, '0') || '0000Z' AS pub,
  CASE WHEN o.o_orderkey % 10 = 0 THEN 'PROVISIONAL'
       ELSE 'RELEASE-' || cast(2021 + o.o_orderkey % 4 AS string) END AS rel,
  CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS positioned,
  lpad(cast(o.o_custkey % 5 AS string), 3, '0') AS h,
  lpad(cast(10 * (1 + o.o_custkey % 3) AS string), 3, '0') AS v,
  CASE WHEN o.o_orderkey % 2 = 0 THEN '030' ELSE '001' END AS tmi,
  o.o_orderkey % 50 AS kind,
  o.o_custkey * 1000 + o.o_orderkey % 997 AS size,
  o.o_totalprice AS price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

_NAMED = f"""
SELECT p.*,
  CASE
    WHEN kind = 1 THEN 'variables'
    WHEN kind = 2 THEN 'readme'
    WHEN kind = 3 THEN 'sensor_positions'
    WHEN kind = 4 THEN 'science_review_flags'
    WHEN status = 'P' THEN 'ord_labPending'
    WHEN status = 'O' THEN 'ord_openSummary'
    WHEN positioned = 1 THEN 'ord_fulfilled_' || CASE WHEN tmi = '030' THEN '30min' ELSE '1min' END
    ELSE 'ord_fulfilled'
  END AS part_name,
  CASE
    WHEN kind IN (1, 2, 3, 4) THEN 0
    WHEN status = 'P' THEN 2
    ELSE 1
  END AS family
FROM ({_PARTS}) p
"""

MANIFEST_SQL = f"""
SELECT
  'store/OBS.' || dom || '.' || st || '.' || prod || '.' || mon || '.' || pkg || '.' || pub || '.' || rel
    || '/' || name AS path,
  size,
  CASE WHEN part_name = 'variables' THEN md5(prod || '.' || cast(file_id % 3 AS string)) END AS md5,
  name,
  prod AS product,
  CASE WHEN family = 2 THEN NULL ELSE dom END AS domain,
  CASE WHEN family = 2 THEN NULL ELSE st END AS site,
  CASE WHEN family = 2 THEN lab_name END AS lab,
  CASE WHEN part_name IN ('variables', 'readme') THEN NULL ELSE part_name END AS table_name,
  CASE
    WHEN part_name IN ('variables', 'readme') THEN NULL
    WHEN part_name = 'sensor_positions' THEN 'site-all'
    WHEN part_name = 'science_review_flags' THEN 'site-date'
    WHEN family = 2 THEN 'lab'
    WHEN part_name = 'ord_openSummary' THEN 'site-all'
    ELSE 'site-date'
  END AS table_type,
  CASE WHEN part_name LIKE 'ord_fulfilled_%' THEN h END AS hor,
  CASE WHEN part_name LIKE 'ord_fulfilled_%' THEN v END AS ver,
  CASE WHEN part_name LIKE 'ord_fulfilled_%' THEN tmi END AS time_index,
  mon AS month,
  pkg AS package,
  pub AS publication,
  rel AS release,
  file_id,
  price
FROM (
  SELECT n.*,
    CASE
      WHEN family = 2 THEN 'OBS.' || lab_name || '.' || prod || '.' || part_name || '.' || pub || '.csv'
      WHEN part_name IN ('variables', 'sensor_positions') THEN
        'OBS.' || dom || '.' || st || '.' || prod || '.' || part_name || '.' || pub || '.csv'
      WHEN part_name = 'readme' THEN
        'OBS.' || dom || '.' || st || '.' || prod || '.' || part_name || '.' || pub || '.txt'
      WHEN part_name = 'ord_openSummary' THEN
        'OBS.' || dom || '.' || st || '.' || prod || '.' || part_name || '.' || pkg || '.' || pub || '.csv'
      WHEN positioned = 1 AND family = 1 THEN
        'OBS.' || dom || '.' || st || '.' || prod || '.' || h || '.' || v || '.' || tmi || '.' || part_name
          || '.' || mon || '.' || pkg || '.' || pub || '.csv'
      ELSE
        'OBS.' || dom || '.' || st || '.' || prod || '.' || part_name || '.' || mon || '.' || pkg || '.' || pub || '.csv'
    END AS name
  FROM ({_NAMED}) n
) f
"""

# Versioned records: every line item is a version of its order's record.
VERSIONS_SQL = """
SELECT
  'R' || cast(l_orderkey AS string) AS srfID,
  cast(l_shipdate AS string) AS lastUpdateDateTime,
  l_linenumber AS tiebreak,
  l_partkey, l_suppkey, l_quantity
FROM lineitem
"""
