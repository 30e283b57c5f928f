"""CSV scans of published files whose columns drift over time.

Spark's CSV reader maps columns by *position*, for all files of a read alike;
published files of one table differ in which columns they have and in what
order.  So the scan is by name, in two steps:

1. the header line of every file is read on the executors; the files are
   grouped by header (a handful of them, however many files there are);
2. each group is one native scan with its header as the schema, and the groups
   are a union by name, columns that a group lacks null.

The result is an ordinary lazy plan, so Catalyst does the rest: columns that
aren't used aren't converted (``ReadSchema``), predicates on cells reach the
reader (``PushedFilters``), and predicates on what a file's path says (its site,
month, publication or release, all expressions of ``file``) choose the files
before any is opened.  Spark packs small files into partitions by size and
splits large ones; a quoted line break can't be split at, so a large file is
split only if no line of it has an odd number of quotes.

The reader lists files on the driver, as every Spark file scan does: a path and
a size for each file of the scan.
"""

from __future__ import annotations

import csv
import io
import os
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N

NULL_TOKEN = "NA"
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": NULL_TOKEN,
    "emptyValue": NULL_TOKEN,
    "mode": "FAILFAST",
}
#: Files from this size on are split if their line breaks allow it.
SPLIT_BYTES = 128 << 20
#: What the decoder puts in place of bytes that are not UTF-8.
UNDECODED = "\ufffd"


def _local_path(path: str) -> str | None:
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" not in path:
        return path
    return None


def open_binary(path: str):
    """Open any Hadoop-style path for reading (local, HDFS, S3)."""
    local = _local_path(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow import fs as pafs

    filesystem, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return filesystem.open_input_stream(inner)


def read_header(path: str) -> list[str]:
    """The names in a file's first record; none for an empty file."""
    with io.TextIOWrapper(open_binary(path), encoding="utf-8-sig", newline="") as fh:
        return next(csv.reader(fh), [])


def file_size(path: str) -> int:
    local = _local_path(path)
    if local is not None:
        return os.path.getsize(local)
    from pyarrow import fs as pafs

    filesystem, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return filesystem.get_file_info(inner).size or 0


def _probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        headers, sizes = [], []
        for p, size in zip(pdf["path"], pdf["size"]):
            try:
                headers.append(read_header(p))
                sizes.append(file_size(p) if pd.isna(size) else int(size))
            except (OSError, UnicodeDecodeError, csv.Error) as e:
                raise ValueError(f"the header of {p} can't be read: {e}") from e
        yield pd.DataFrame({"path": pdf["path"], "size": sizes, "header": headers})


def probe_headers(files: DataFrame) -> DataFrame:
    """(path, size, header array<string>) for each distinct path of ``files``.
    One first-line read per file, on the executors; an unreadable file fails."""
    size = F.max(F.col("size").cast("long")) if "size" in files.columns else F.lit(None).cast("long")
    paths = files.groupBy(F.col("path").cast("string").alias("path")).agg(size.alias("size"))
    tasks = paths.sparkSession.sparkContext.defaultParallelism
    return paths.repartition(tasks, "path").mapInPandas(_probe, "path string, size long, header array<string>")


def header_groups(files: DataFrame) -> list[tuple[tuple[str, ...], list[tuple[str, int]]]]:
    """The files of ``files`` by header: (header, [(path, size)]), in the order
    of the first path that has each.  Empty files are left out."""
    groups: dict[tuple[str, ...], list[tuple[str, int]]] = {}
    for r in probe_headers(files).filter(F.size("header") > 0).collect():  # as a scan's own listing
        groups.setdefault(tuple(r["header"]), []).append((r["path"], r["size"]))
    return sorted(((h, sorted(paths)) for h, paths in groups.items()), key=lambda g: g[1][0])


def string_schema(names: Sequence[str]) -> T.StructType:
    """S3: every field a string, in the given order."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_csv_group(spark: SparkSession, paths: Sequence[str], header: Sequence[str], **options) -> DataFrame:
    """T1 for files that share one header: string columns by that header,
    plus the source ``file`` (T6).  Of columns that share a name the last counts."""
    opts = {**CSV_OPTIONS, **options}
    plain = len({h.lower() for h in header}) == len(header) and "" not in header
    names = list(header) if plain else [f"_cell{i}" for i in range(len(header))]
    df = with_file(spark.read.options(**opts).schema(string_schema(names)).csv(list(paths)))
    if plain:
        return df
    last = {h: n for h, n in zip(header, names)}
    return df.select(*[F.col(n).alias(h) for h, n in last.items()], "file")


def with_file(df: DataFrame) -> DataFrame:
    """The source file of each row."""
    return df.withColumn("file", F.col("_metadata.file_path"))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, missing columns null (inputs all strings)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_headers(files: DataFrame) -> list[tuple[str, ...]]:
    """The distinct headers of ``files``, in the order of the first (smallest)
    path that has each.  One row per header reaches the driver."""
    probed = probe_headers(files).filter(F.size("header") > 0)
    first = probed.groupBy("header").agg(F.min("path").alias("first_path"))
    return [tuple(r["header"]) for r in first.orderBy("first_path").collect()]


def superset_header(spark: SparkSession, files: DataFrame) -> list[str]:
    """Ordered union of header names over files, by first appearance in the
    sorted file order."""
    return list(dict.fromkeys(h for header in distinct_headers(files) for h in header))


def whole_line_files(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Those of ``paths`` in which every line is whole: none has an odd number
    of quotes, so a record may begin at any line.  One text scan of the files."""
    lines = spark.read.text(list(paths)).select("value", N.plain_path("_metadata.file_path").alias("file"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1
    broken = {r["file"] for r in lines.where(odd).select("file").distinct().collect()}
    return {p for p in paths if (_local_path(p) or p) not in broken}


def _decoded(name: str) -> Column:
    """A cell, failing on bytes that are not UTF-8."""
    c = F.col(f"`{name}`")
    said = F.concat(F.col("file"), F.lit(f" can't be read as CSV: {name} has bytes that are not UTF-8"))
    return F.when(F.contains(c, F.lit(UNDECODED)), F.raise_error(said)).otherwise(c).alias(name)


def scan_csv(spark: SparkSession, files: DataFrame, *, checked: bool = True) -> DataFrame | None:
    """Scan the files of ``files`` (a manifest or any frame with ``path``
    and perhaps ``size``) as strings by name, with the ``file`` column (T6).
    A path that occurs twice is read once; empty files have no rows.  Returns
    None when no file has a header.

    With ``checked``, a row with more or fewer cells than its header, and a cell
    that isn't UTF-8, fail the scan with the file's path.  Without, the plan is
    open to pushdown on cells: only the cells a query uses are looked at, lacking
    ones are null, and undecodable bytes show as U+FFFD."""
    groups = header_groups(files)
    if not groups:
        return None
    large = [p for _, own in groups for p, size in own if size >= SPLIT_BYTES]
    whole = whole_line_files(spark, large) if large else set()
    pruned = {} if checked else {"mode": "PERMISSIVE"}
    parts = []
    for header, own in groups:
        split = [p for p, _ in own if p in whole]
        rest = [p for p, _ in own if p not in whole]
        if rest:
            parts.append(read_csv_group(spark, rest, header, columnPruning=str(not checked).lower(), **pruned))
        if split:
            parts.append(read_csv_group(spark, split, header, columnPruning=str(not checked).lower(), multiLine="false", **pruned))
    columns = dict.fromkeys(h for header, _ in groups for h in header)
    out = union_by_name(parts).select(*[f"`{c}`" for c in columns], "file")
    return out.select(*[_decoded(c) for c in columns], "file") if checked else out


def _fits(c: Column) -> Column:
    """1 whole numbers, 2 numbers, 3 timestamps, 4 text: the narrowest type
    that reads a cell (null: any)."""
    return (
        F.when(c.isNull(), F.lit(0)).when(c.try_cast("long").isNotNull(), 1).when(c.try_cast("double").isNotNull(), 2)
        .when(c.try_cast("timestamp").isNotNull(), 3).otherwise(4)
    )


def scan_csv_inferred(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """T4: the scan with the narrowest type that reads all cells of a column:
    long, double, timestamp, else text (also where numbers and times mix).  One
    aggregate over the scan decides."""
    raw = scan_csv(spark, files)
    if raw is None:
        return None
    names = [c for c in raw.columns if c != "file"]
    seen = raw.agg(*[F.collect_set(_fits(F.col(f"`{c}`"))).alias(str(i)) for i, c in enumerate(names)]).first()
    out = []
    for i, c in enumerate(names):
        kinds = set(seen[i]) - {0}
        kind = "long" if kinds == {1} else "double" if kinds and kinds <= {1, 2} else "timestamp" if kinds == {3} else "string"
        out.append(F.col(f"`{c}`").cast(kind).alias(c))
    return raw.select(*out, "file")
