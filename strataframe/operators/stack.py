"""Stack operators (T3, T7-T13, T19): provenance, position, order, guards,
versioned de-duplication and sinks, all over lazy DataFrames.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names as N

RELEASE_PATTERN = r"^RELEASE-"


def union_evolving(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, missing columns null; a column typed differently
    in two inputs becomes text in all of them (no implicit coercion)."""
    frames = list(frames)
    types: dict[str, set[str]] = {}
    for f in frames:
        for fld in f.schema.fields:
            types.setdefault(fld.name, set()).add(fld.dataType.simpleString())
    conflicted = {c for c, ts in types.items() if len(ts) > 1}
    fixed = [
        f.select(*[F.col(c).cast("string").alias(c) if c in conflicted else F.col(c) for c in f.columns])
        for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fixed)


def with_provenance(df: DataFrame, manifest: DataFrame | None = None, *, file_col: str = "file") -> DataFrame:
    """``publicationDate`` from the file's basename and ``release`` from
    its directory (null where absent).  With ``manifest`` the release comes
    from the manifest row of the file instead (a join on the file path)."""
    f = F.col(file_col)
    out = df.withColumn("publicationDate", N.publication_stamp(N.basename(f)))
    if manifest is None:
        return out.withColumn("release", N.release_of(f))
    # by the whole path: one name may be published in several releases
    rel = manifest.groupBy(N.plain_path(F.col("path")).alias("_mpath")).agg(F.max("release").alias("_mrel"))
    joined = out.join(rel, N.plain_path(f) == F.col("_mpath"), "left")
    return joined.withColumn("release", F.col("_mrel")).drop("_mpath", "_mrel")


def with_position(df: DataFrame, table_type: str, *, has_position: bool, file_col: str = "file") -> DataFrame:
    """For non-lab tables without ``siteID``: ``domainID``, ``siteID``
    (and ``horizontalPosition``, ``verticalPosition`` when the files carry a
    location block) from the file name, placed first."""
    if table_type == "lab" or "siteID" in df.columns:
        return df
    name = N.basename(F.col(file_col))
    front = [N.domain_of(name).alias("domainID"), N.site_of(name).alias("siteID")]
    if has_position:
        front += [N.hor_of(name).alias("horizontalPosition"), N.ver_of(name).alias("verticalPosition")]
    return df.select(*front, *[F.col(c) for c in df.columns])


def order_stacked(df: DataFrame) -> DataFrame:
    """Order by domain, site[, HOR, VER[, endDateTime]] (a range shuffle;
    opt-in)."""
    keys = [c for c in ("domainID", "siteID") if c in df.columns]
    if "horizontalPosition" in df.columns:
        keys += ["horizontalPosition", "verticalPosition"]
        if "endDateTime" in df.columns:
            keys.append("endDateTime")
    return df.orderBy(*keys) if keys else df


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """T10."""
    return df.drop(*cols)


def release_check(df: DataFrame) -> DataFrame:
    """T11 check row: number of distinct ``RELEASE-`` tags and the sorted tags."""
    rel = F.col("release")
    return df.agg(
        F.count_distinct(F.when(rel.rlike(RELEASE_PATTERN), rel)).cast("bigint").alias("n_releases"),
        F.array_join(F.array_sort(F.collect_set(F.when(rel.rlike(RELEASE_PATTERN), rel))), ",").alias("releases"),
        F.max((rel == "PROVISIONAL").cast("int")).alias("has_provisional"),
    )


def guard_single_release(df: DataFrame) -> DataFrame:
    """Raise when more than one ``RELEASE-`` tag is present
    (PROVISIONAL may coexist); returns the input."""
    row = release_check(df).collect()[0]
    if row["n_releases"] > 1:
        raise ValueError(f"data from more than one release: {row['releases']}")
    return df


def dedupe_latest_by_id(df: DataFrame, *, id_col: str = "srfID", ts_col: str = "lastUpdateDateTime",
                        tiebreak: Sequence[str] | None = None, keep_ties: bool = False) -> DataFrame:
    """Drop identical rows, then per id keep the row(s) with the
    greatest ``ts_col``.

    * ties: the first by ``tiebreak`` (default: a hash of the row), or all
      of them with ``keep_ties=True`` (T13);
    * an id whose stamps include a null keeps all its rows;
    * rows with a null id are kept.

    Skew: the greatest stamp and whether one is missing are a partial
    aggregate by id; the rows meet it again in an ordinary join, whose hot ids
    Spark splits, and only rows with the greatest stamp are ranked.  The
    distinct rows are one exchange that all steps reuse.
    """
    uniq = df.dropDuplicates()
    ts = F.col(ts_col)
    known = uniq.filter(F.col(id_col).isNotNull())
    flags = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(ts).alias("_latest"), F.bool_or(ts.isNull()).alias("_open"))
    newest = known.join(flags, F.col(id_col) == F.col("_id")).filter(F.col("_open") | (ts == F.col("_latest")))
    if not keep_ties:
        tail = [F.xxhash64(*df.columns).asc()] if tiebreak is None else [F.col(c).asc() for c in tiebreak]
        w = Window.partitionBy(id_col, F.when(F.col("_open"), F.struct(*df.columns))).orderBy(*tail)
        newest = newest.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1")
    return newest.select(*df.columns).unionByName(uniq.filter(F.col(id_col).isNull()))


def write_stacked(tables: dict[str, DataFrame], out_dir: str, fmt: str = "csv", *,
                  partition_by: str | None = "siteID") -> dict[str, str]:
    """One dataset per table under ``out_dir``: CSV with a header and
    ``NA`` for nulls, or Parquet partitioned by site."""
    paths = {}
    for name, df in sorted(tables.items()):
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if fmt == "csv":
            (w.option("header", "true").option("nullValue", "NA").option("escape", '"')
             .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").csv(path))
        elif fmt == "parquet":
            if partition_by and partition_by in df.columns:
                w = w.partitionBy(partition_by)
            w.parquet(path)
        else:
            raise ValueError(f"unknown format {fmt}")
        paths[name] = path
    return paths


# --------------------------------------------------------------------------
# Sorted sink
# --------------------------------------------------------------------------

def write_sorted(df: DataFrame, keys: Sequence[str], path: str, *, max_rows: int = 0) -> str:
    """``df`` as Parquet files in the order of ``keys`` (nulls first):
    rows are dealt by ranges of the keys and sorted within, so that the files by
    their bounds, and the rows in each, are in order, and no task sorts more
    than its range.  ``max_rows`` bounds the rows of a file (0: no bound)."""
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.write.option("maxRecordsPerFile", max_rows).parquet(path)
    return path


def sorted_bounds(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """``(file, first, last, n_rows, n_faults)`` of a sorted sink: the least and
    the greatest key of each file, and how many of its rows come after a greater
    one.  A ranking within each file; nothing meets over all files."""
    rows = spark.read.parquet(path).select(F.struct(*keys).alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    return rows.withColumn("fault", before > F.col("key")).groupBy("file").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.count(F.lit(1)).alias("n_rows"), F.count_if("fault").alias("n_faults")
    )


def order_faults(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """One row: files of a sorted sink, their rows, and where their order is
    broken: inside files, and between files, whose bounds overlap.  What is
    ranked over all files is a row of bounds for each."""
    bounds = sorted_bounds(spark, path, keys)
    ranked = bounds.withColumn("overlap", F.lag("last").over(Window.orderBy("first", "last")) > F.col("first"))
    return ranked.agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum("n_faults") + F.count_if("overlap"), F.lit(0)).cast("bigint").alias("n_faults"),
    )


# --------------------------------------------------------------------------
# Committed sink
# --------------------------------------------------------------------------

COMMITS = "commits"


def write_committed(tables: dict[str, DataFrame], out_dir: str, commit_id: str, *, max_rows: int = 1_000_000) -> int:
    """T19, all or none: each table goes to a new folder of its own under
    ``out_dir``, files of at most ``max_rows`` rows, and only when all are
    written one file of ``commits`` says which folders count from now on.  Until
    then, and after any failure, readers see the commit before.

    Replayed with a ``commit_id`` that is already there it writes nothing.
    Returns the commit's number (from 1).  One writer at a time."""
    if not tables:
        raise ValueError("no tables to write")
    spark = next(iter(tables.values())).sparkSession
    out_dir = out_dir.rstrip("/")
    done = committed(spark, out_dir)
    if done is not None:
        row = done.agg(F.max("number").alias("last"), F.max(F.when(F.col("commit_id") == commit_id, F.col("number"))).alias("same")).first()
        if row["same"] is not None:
            return row["same"]
    number = 1 if done is None else row["last"] + 1
    rows = []
    for name, df in sorted(tables.items()):
        folder = f"data/{name}/{uuid.uuid4().hex}"
        df.write.option("maxRecordsPerFile", max_rows).parquet(f"{out_dir}/{folder}")
        rows.append((number, commit_id, name, folder))
    schema = "number long, commit_id string, `table` string, folder string"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{out_dir}/{COMMITS}")
    return number


def committed(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """``(number, commit_id, table, folder)`` of all commits; None before the first."""
    path = f"{out_dir.rstrip('/')}/{COMMITS}"
    try:
        return spark.read.schema("number long, commit_id string, `table` string, folder string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_committed(spark: SparkSession, out_dir: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of a commit, by default the last; {} before the first."""
    done = committed(spark, out_dir)
    if done is None:
        return {}
    if number is None:
        number = done.agg(F.max("number")).first()[0]
    rows = done.filter(F.col("number") == number).collect()
    return {r["table"]: spark.read.parquet(f"{out_dir.rstrip('/')}/{r['folder']}") for r in sorted(rows, key=lambda r: r["table"])}
