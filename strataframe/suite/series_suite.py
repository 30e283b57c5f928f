"""Checked queries for the time-series operators (E1-E14) on a long series
table built from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as E
from ..operators.stack import union_evolving
from .registry import register
from .shapes import shape

_HALF = "CASE WHEN minute(ts) < 30 THEN '00' ELSE '30' END"
_HOUR = "lpad(cast(hour(ts) AS string), 2, '0')"
_DAY = ("cast(year(ts) AS string) || '-' || lpad(cast(month(ts) AS string), 2, '0') || '-'"
        " || lpad(cast(day(ts) AS string), 2, '0')")

SERIES_SQL = f"""
SELECT
  'file_' || cast(user_id % 6 AS string) || '.h5' AS file,
  'ST0' || cast(user_id % 6 AS string) AS site,
  '/ST0' || cast(user_id % 6 AS string) || '/dp01/data/' || event_type || '/'
    || lpad(cast(user_id % 3 AS string), 3, '0') || '_' || lpad(cast(10 * (1 + user_id % 2) AS string), 3, '0')
    || '_30m/' || CASE WHEN event_id % 5 = 0 THEN 'qfqm' ELSE 'val' END AS dataset,
  {_DAY} || 'T' || {_HOUR} || ':' || {_HALF} || ':00.000Z' AS timeBgn,
  CASE WHEN event_id % 50 = 0 THEN '2024-12-31T23:59:59.000Z'
       ELSE {_DAY} || 'T' || {_HOUR} || ':' || CASE WHEN minute(ts) < 30 THEN '29' ELSE '59' END || ':59.000Z'
  END AS timeEnd,
  CASE WHEN event_id % 2 = 0 THEN 'mean' ELSE 'max' END AS stat,
  value, event_id,
  lpad(cast(user_id % 3 AS string), 3, '0') AS hor,
  lpad(cast(10 * (1 + user_id % 2) AS string), 3, '0') AS ver,
  event_type,
  CASE WHEN event_id % 5 = 0 THEN 'qfqm' ELSE 'val' END AS nm
FROM events
"""
S_CTE = f"WITH s AS ({SERIES_SQL}),\n"
_TS = "CAST(replace(replace({c}, 'T', ' '), 'Z', '') AS TIMESTAMP)"
CLEAN = ("clean AS (SELECT * FROM s WHERE abs(epoch(" + _TS.format(c="timeEnd") + ") - epoch("
         + _TS.format(c="timeBgn") + ")) < 86399)\n")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
WIDE_COLUMNS = [f"data.{e}.{n}.{s}" for e in EVENT_TYPES for n in ("qfqm", "val") for s in ("max", "mean")]


def series(spark, sf_dir):
    raw = shape(spark, sf_dir, SERIES_SQL).select("file", "site", "dataset", "timeBgn", "timeEnd", "stat",
                                                  "value", "event_id")
    return E.parse_dataset_path(raw)


def prepared(spark, sf_dir):
    parsed = E.parse_series_time(series(spark, sf_dir))
    return E.drop_day_fillers(E.filter_series(parsed, "dp01", avg=30))


# Paths of every kind: three-part and two-part positions, a lettered ver, no
# position at all, and a part between position and name.
PATHS_SQL = """
SELECT event_id, event_type,
  '/ST0' || cast(user_id % 6 AS string) || CASE event_id % 5
    WHEN 0 THEN '/dp01/data/' || event_type || '/000_010_30m/val'
    WHEN 1 THEN '/dp01/data/' || event_type || '/010_30m/val'
    WHEN 2 THEN '/dp01/data/' || event_type || '/co2Low_30m/val'
    WHEN 3 THEN '/dp04/data/' || event_type || '/nsae'
    ELSE '/dp02/data/' || event_type || '/000_020_02m/sub/val' END AS dataset,
  event_id % 5 AS kind
FROM events
"""


@register("parse_dataset_path", f"""
SELECT event_id, CASE kind WHEN 3 THEN 'dp04' WHEN 4 THEN 'dp02' ELSE 'dp01' END AS level, 'data' AS category,
  event_type AS system, CASE WHEN kind IN (0, 4) THEN '000' END AS hor,
  CASE kind WHEN 0 THEN '010' WHEN 1 THEN '010' WHEN 4 THEN '020' END AS ver,
  CASE WHEN kind IN (0, 1, 2) THEN '30m' WHEN kind = 4 THEN '02m' END AS tmi,
  CASE WHEN kind = 3 THEN 'nsae' ELSE 'val' END AS name, CASE WHEN kind = 2 THEN 'co2Low' END AS oth,
  CASE WHEN kind = 4 THEN 'sub' END AS subsys
FROM ({PATHS_SQL}) p
""")
def q_parse_dataset_path(spark, sf_dir):
    out = E.parse_dataset_path(shape(spark, sf_dir, PATHS_SQL))
    return out.select("event_id", "level", "category", "system", "hor", "ver", "tmi", "name", "oth", "subsys")


# Even files name the wanted variable as a system, odd ones as a dataset.
BY_FILE_SQL = """
SELECT event_id, 'f' || cast(user_id % 4 AS string) AS file, event_type,
  '/ST00/dp01/data/' || CASE WHEN user_id % 2 = 0 THEN event_type || '/000_010_30m/val' ELSE 'sys/000_010_30m/' || event_type END AS dataset
FROM events
"""


@register("filter_series", f"""
SELECT event_id FROM ({BY_FILE_SQL}) s WHERE event_type IN ('click', 'view')
""")
def q_filter_series(spark, sf_dir):
    rows = E.parse_dataset_path(shape(spark, sf_dir, BY_FILE_SQL))
    return E.filter_series(rows, "dp01", var=["click", "view"], avg=30).select("event_id")


@register("parse_series_time", S_CTE.rstrip(",\n") + f"""
SELECT event_id, {_TS.format(c='timeBgn')} AS timeBgn, {_TS.format(c='timeEnd')} AS timeEnd FROM s
""")
def q_parse_series_time(spark, sf_dir):
    out = E.parse_series_time(series(spark, sf_dir))
    return out.select("event_id", F.col("timeBgn").cast("timestamp_ntz").alias("timeBgn"),
                      F.col("timeEnd").cast("timestamp_ntz").alias("timeEnd"))


@register("drop_day_fillers", S_CTE + CLEAN + "SELECT event_id FROM clean")
def q_drop_day_fillers(spark, sf_dir):
    return E.drop_day_fillers(E.parse_series_time(series(spark, sf_dir))).select("event_id")


@register("consensus_timestamps", S_CTE + CLEAN + f"""
SELECT file, hor, ver, {_TS.format(c='timeBgn')} AS timeBgn, {_TS.format(c="arg_min(timeEnd, dataset || timeEnd)")} AS timeEnd
FROM clean WHERE nm NOT IN ('qfqm', 'turb', 'foot') GROUP BY file, hor, ver, timeBgn
""")
def q_consensus_timestamps(spark, sf_dir):
    c = E.consensus_timestamps(prepared(spark, sf_dir))
    return c.select("file", "hor", "ver", F.col("timeBgn").cast("timestamp_ntz").alias("timeBgn"),
                    F.col("timeEnd").cast("timestamp_ntz").alias("timeEnd"))


def _wide_sql() -> str:
    cols = ",\n  ".join(
        f"arg_min(value, event_id) FILTER (WHERE col = '{c}') AS \"{c}\"" for c in WIDE_COLUMNS
    )
    return S_CTE + CLEAN + f""",
cons AS (SELECT file, hor, ver, timeBgn, arg_min(timeEnd, dataset || timeEnd) AS timeEnd FROM clean
         WHERE nm NOT IN ('qfqm', 'turb', 'foot') GROUP BY 1, 2, 3, 4),
lng AS (SELECT file, hor, ver, timeBgn, 'data.' || event_type || '.' || nm || '.' || stat AS col, value, event_id
        FROM clean)
SELECT cons.file, cons.hor, cons.ver, {_TS.format(c='cons.timeBgn')} AS timeBgn,
  {_TS.format(c='cons.timeEnd')} AS timeEnd,
  {cols}
FROM cons LEFT JOIN lng ON cons.file = lng.file AND cons.hor = lng.hor AND cons.ver = lng.ver
  AND cons.timeBgn = lng.timeBgn
GROUP BY cons.file, cons.hor, cons.ver, cons.timeBgn, cons.timeEnd
"""


@register("merge_series_wide", _wide_sql())
def q_merge_series_wide(spark, sf_dir):
    df = prepared(spark, sf_dir)
    wide = E.merge_series_wide(df, columns=WIDE_COLUMNS, order_col="event_id")
    return wide.withColumn("timeBgn", F.col("timeBgn").cast("timestamp_ntz")) \
        .withColumn("timeEnd", F.col("timeEnd").cast("timestamp_ntz"))


@register("series_variables", S_CTE.rstrip(",\n") + """
SELECT DISTINCT 'data' AS category, event_type AS system, nm AS variable, stat, NULL AS units
FROM s WHERE file = (SELECT min(file) FROM s)
""")
def q_series_variables(spark, sf_dir):
    return E.series_variables(series(spark, sf_dir))


@register("stack_months", S_CTE + CLEAN + f"""
SELECT file, hor, ver, {_TS.format(c='timeBgn')} AS timeBgn, value, event_id FROM clean
""")
def q_stack_months(spark, sf_dir):
    df = prepared(spark, sf_dir)
    a = df.filter(F.col("timeBgn") < F.lit("2024-01-15").cast("timestamp")).select(
        "file", "hor", "ver", "timeBgn", "value", "event_id")
    b = df.filter(F.col("timeBgn") >= F.lit("2024-01-15").cast("timestamp")).select(
        "file", "hor", "ver", "timeBgn", "event_id", "value")
    out = E.stack_months([a, b])
    return out.withColumn("timeBgn", F.col("timeBgn").cast("timestamp_ntz"))


# Carbon and water isotopes in one stack.  Of some files the early intervals
# are short and the others long, of some the other way round.
ISOTOPE_SQL = f"""
SELECT 'iso_' || cast(user_id % 5 AS string) || '.h5' AS file,
  '/ST00/dp01/data/' || CASE WHEN event_id % 2 = 0 THEN 'isoCo2/00' || cast(user_id % 2 AS string) || '_010_09m/dlta13CCo2'
                             ELSE 'isoH2o/00' || cast(user_id % 2 AS string) || '_010_09m/dlta18OH2o' END AS dataset,
  {_DAY} || 'T' || {_HOUR} || ':00:00.000Z' AS timeBgn,
  {_DAY} || 'T' || {_HOUR} || CASE WHEN (user_id % 5 < 2) = (day(ts) < 4) THEN ':06:00.000Z' ELSE ':09:00.000Z' END AS timeEnd
FROM events
"""
_FIRST_ROWS = f"""
iv AS (SELECT DISTINCT file, split_part(split_part(dataset, '/', 6), '_', 1) AS hor, timeBgn,
         epoch({_TS.format(c='timeEnd')}) - epoch({_TS.format(c='timeBgn')}) AS i FROM s),
f AS (SELECT file, avg(i) AS m FROM (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY hor, timeBgn) AS r FROM iv) t WHERE r <= 20 GROUP BY file)
"""


@register("isotope_cadence_files", f"""
WITH s AS ({ISOTOPE_SQL}), {_FIRST_ROWS}
SELECT file, bool_or(dataset LIKE '%dlta13CCo2') AS has_carbon, bool_or(dataset LIKE '%dlta18OH2o') AS has_water,
  any_value(m) AS mean_interval
FROM s JOIN f USING (file) GROUP BY file
""")
def q_isotope_cadence_files(spark, sf_dir):
    return E.isotope_cadence_files(E.parse_series_time(E.parse_dataset_path(shape(spark, sf_dir, ISOTOPE_SQL))))


@register("isotope_cadence_check", f"""
WITH s AS ({ISOTOPE_SQL}), {_FIRST_ROWS}
SELECT n AS averaging, bool_or(dataset LIKE '%dlta13CCo2') AS has_carbon, bool_or(dataset LIKE '%dlta18OH2o') AS has_water,
  (SELECT round(min(m), 4) FROM f) AS min_mean_interval,
  n = 9 AND bool_or(dataset LIKE '%dlta13CCo2') AND bool_or(dataset LIKE '%dlta18OH2o') AND (SELECT min(m) < 537 FROM f) AS flag
FROM s, (VALUES (9), (30)) v(n) GROUP BY n
""")
def q_isotope_cadence_check(spark, sf_dir):
    rows = E.parse_series_time(E.parse_dataset_path(shape(spark, sf_dir, ISOTOPE_SQL)))
    each = [E.isotope_cadence_check(rows, avg).withColumn("averaging", F.lit(avg)) for avg in (9, 30)]
    return each[0].unionByName(each[1])


# Two thousand variables: fifty systems of twenty names, each in two statistics.
MANY_SQL = f"""
SELECT 'file_' || cast(user_id % 3 AS string) AS file,
  '/ST00/dp01/data/s' || cast(user_id % 50 AS string) || '/000_010_30m/v' || cast(event_id % 20 AS string) AS dataset,
  {_DAY} || 'T' || {_HOUR} || ':00:00.000Z' AS timeBgn, {_DAY} || 'T' || {_HOUR} || ':30:00.000Z' AS timeEnd,
  CASE WHEN event_type IN ('click', 'view') THEN 'mean' ELSE 'max' END AS stat, value, event_id
FROM events
"""


@register("merge_series_many", f"""
WITH s AS ({MANY_SQL})
SELECT file, {_TS.format(c='timeBgn')} AS timeBgn, {_TS.format(c='min(timeEnd)')} AS timeEnd,
  'data.' || split_part(dataset, '/', 5) || '.' || split_part(dataset, '/', 7) || '.' || stat AS variable,
  arg_min(value, event_id) AS value
FROM s GROUP BY file, timeBgn, variable
""")
def q_merge_series_many(spark, sf_dir):
    parsed = E.parse_series_time(E.parse_dataset_path(shape(spark, sf_dir, MANY_SQL)))
    wide = E.merge_series_wide(parsed, order_col="event_id")
    names = [c for c in wide.columns if c.startswith("data.")]
    # back to rows, to be compared: every column of the wide table that has a value
    cells = F.from_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])), "map<string,double>")  # leaves nulls out
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("timeBgn", "timeEnd")]
    return wide.select("file", *times, F.explode(cells).alias("variable", "value"))


# Files of both packages; a site, a root and a validation level each, some
# attributes vectors, some in few files only, and some files not readable.
ATTRIBUTE_FILES_SQL = f"""
SELECT DISTINCT 'ST0' || cast(user_id % 6 AS string) AS site,
  'OBS.ST0' || cast(user_id % 6 AS string) || '.' || CASE WHEN user_id % 2 = 0 THEN {_DAY} || '.expanded' ELSE substr({_DAY}, 1, 7) || '.basic' END
    || '.u' || cast(user_id AS string) || '.h5' AS file, user_id
FROM events
"""


@register("file_attributes", f"""
WITH f AS (SELECT *, CASE WHEN user_id % 2 = 0 THEN regexp_extract(file, '20[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}') ELSE regexp_extract(file, '20[0-9]{{2}}-[0-9]{{2}}') END AS date,
             user_id % 7 <> 0 AS readable FROM ({ATTRIBUTE_FILES_SQL}) x)
SELECT 'site' AS kind, site, date, CASE WHEN readable THEN cast(user_id AS varchar) || ',x' END AS "LatTow",
  CASE WHEN readable AND user_id % 3 = 0 THEN 'rare' END AS "Extra", NULL AS "Vers", NULL AS "CoefVali" FROM f
UNION ALL SELECT 'root', site, date, NULL, NULL, CASE WHEN readable THEN 'v' || cast(user_id % 4 AS varchar) END, NULL FROM f
UNION ALL SELECT 'val', site, date, NULL, NULL, NULL, CASE WHEN readable AND user_id % 5 <> 0 THEN '1,2,' || cast(user_id AS varchar) END FROM f
""")
def q_file_attributes(spark, sf_dir):
    files = shape(spark, sf_dir, ATTRIBUTE_FILES_SQL)
    read = files.filter("user_id % 7 <> 0")
    user = F.col("user_id").cast("string")

    def level(name, *pairs):
        return F.struct(name.alias("level"), F.map_filter(F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)]), lambda k, v: v.isNotNull()).alias("attrs"))

    rare = F.when(F.col("user_id") % 3 == 0, F.array(F.lit("rare")))
    version = F.array(F.concat(F.lit("v"), (F.col("user_id") % 4).cast("string")))
    site = level(F.col("site"), ("LatTow", F.array(user, F.lit("x"))), ("Extra", rare))
    val = level(F.concat(F.lit("/"), F.col("site"), F.lit("/dp01/data/co2/rtioMoleDryCo2Vali")), ("CoefVali", F.array(F.lit("1"), F.lit("2"), user)))
    levels = F.filter(F.array(site, level(F.lit("/"), ("Vers", version)), F.when(F.col("user_id") % 5 != 0, val)), lambda x: x.isNotNull())
    attrs = read.select("file", F.explode(levels).alias("l")).select("file", "l.level", "l.attrs")
    tables = [E.file_attributes(files, attrs, kind).withColumn("kind", F.lit(kind)) for kind in ("site", "root", "val")]
    return union_evolving(tables)


@register("releases_in_paths", """
SELECT DISTINCT CASE WHEN o_orderkey % 10 = 0 THEN 'PROVISIONAL'
       ELSE 'RELEASE-' || cast(2021 + o_orderkey % 4 AS varchar) END AS release FROM orders
""")
def q_releases_in_paths(spark, sf_dir):
    from .manifest_suite import manifest

    return E.releases_in_paths(manifest(spark, sf_dir).select("path"))


@register("guard_single_package", """
SELECT 'basic,expanded' AS packages WHERE (SELECT count(*) FROM orders) > 0
""")
def q_guard_single_package(spark, sf_dir):
    from .manifest_suite import manifest

    return E.package_check(manifest(spark, sf_dir).select("path"))


# Some stamps that no format reads, and one system whose ends are all such.
BAD_SQL = f"""
SELECT dataset, CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 11 = 0 THEN timeBgn || 'x' ELSE timeBgn END AS timeBgn,
  CASE WHEN event_type = 'view' THEN 'never' ELSE timeEnd END AS timeEnd, event_id, event_type
FROM ({SERIES_SQL}) s
"""


@register("time_parse_flags", f"""
SELECT dataset, cast(count(*) FILTER (WHERE event_id % 7 = 0 OR event_id % 11 = 0) AS bigint) AS timeBgn_failed,
  count(*) FILTER (WHERE event_id % 7 <> 0 AND event_id % 11 <> 0) = 0 AS timeBgn_unparsed,
  cast(count(*) FILTER (WHERE event_type = 'view') AS bigint) AS timeEnd_failed,
  count(*) FILTER (WHERE event_type <> 'view') = 0 AS timeEnd_unparsed
FROM ({BAD_SQL}) b GROUP BY dataset
""")
def q_time_parse_flags(spark, sf_dir):
    return E.time_parse_flags(E.parse_series_time(shape(spark, sf_dir, BAD_SQL)))


@register("merge_series_long", S_CTE + CLEAN + f"""
, cons AS (SELECT file, hor, ver, timeBgn, arg_min(timeEnd, dataset || timeEnd) AS timeEnd FROM clean
         WHERE nm NOT IN ('qfqm', 'turb', 'foot') GROUP BY 1, 2, 3, 4)
SELECT cons.file, cons.hor, cons.ver, {_TS.format(c='cons.timeBgn')} AS timeBgn, {_TS.format(c='any_value(cons.timeEnd)')} AS timeEnd,
  'data.' || event_type || '.' || nm || '.' || stat AS variable, arg_min(value, event_id) AS value
FROM cons JOIN clean USING (file, hor, ver, timeBgn) GROUP BY ALL
""")
def q_merge_series_long(spark, sf_dir):
    out = E.merge_series_wide(prepared(spark, sf_dir), order_col="event_id", layout="long")
    return out.withColumn("timeBgn", F.col("timeBgn").cast("timestamp_ntz")).withColumn("timeEnd", F.col("timeEnd").cast("timestamp_ntz"))


@register("series_review_flags", """
WITH v AS (SELECT 'R' || cast(l_orderkey AS varchar) AS srfID, cast(l_shipdate AS varchar) AS lastUpdateDateTime,
                  l_linenumber AS tiebreak FROM lineitem),
u AS (SELECT DISTINCT * FROM v)
SELECT srfID, lastUpdateDateTime, tiebreak FROM u
QUALIFY rank() OVER (PARTITION BY srfID ORDER BY lastUpdateDateTime DESC) = 1
""")
def q_series_review_flags(spark, sf_dir):
    li = shape(spark, sf_dir, "SELECT l_orderkey, l_shipdate, l_linenumber FROM lineitem")
    v = li.select(F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("srfID"),
                  F.col("l_shipdate").cast("string").alias("lastUpdateDateTime"),
                  F.col("l_linenumber").alias("tiebreak"))
    half = F.col("tiebreak") % 2 == 0
    return E.series_review_flags([v.filter(half), v.filter(~half)])
