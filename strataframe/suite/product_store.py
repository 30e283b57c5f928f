"""A second published-file store, of one product with all that a product may
have: tables of either package and of both, variables files that change over
the years, validation, codes, readme and review files, and per-sample files of
two more products.  Written from ``orders``: a folder for each site and year.

* ``prd_both`` in both packages, ``prd_basic``, ``prd_expanded``; ``prd_absent``
  is declared and has no files.
* Three variables versions: until 1995 ``moment`` is written to the second and
  ``amount`` a number; 1996 and 1997 ``moment`` to the minute and ``amount`` text;
  later a number again, and ``grade`` is new.  Until 1997 ``prd_expanded`` is
  said to be basic.
* The folder names of per-sample files carry the product, their names don't.
"""

from __future__ import annotations

import shutil
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, write_once
from .shapes import register_tables

# The subset of SQL that Spark and DuckDB read alike.
ROWS_SQL = """
SELECT 'ST0' || cast(o_custkey % 3 AS string) AS site, year(o_orderdate) AS yr, o_orderkey AS k,
  cast(year(o_orderdate) AS string) || '-01' AS mon, cast(year(o_orderdate) + 25 AS string) || '0601T000000Z' AS stamp,
  cast(o_custkey % 1000 AS string) || '.50' AS amount,
  cast(year(o_orderdate) AS string) || '-' || lpad(cast(month(o_orderdate) AS string), 2, '0') || '-' || lpad(cast(day(o_orderdate) AS string), 2, '0')
    || 'T10:20' || CASE WHEN year(o_orderdate) BETWEEN 1996 AND 1997 THEN 'Z' ELSE ':30Z' END AS moment,
  o_orderstatus AS grade, o_custkey % 7 AS c7
FROM orders
"""
_HEAD = "table,fieldName,description,dataType,units,downloadPkg,pubFormat,primaryKey,categoricalCodeName"
_SECOND, _MINUTE = "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm'Z'(floor)"


def variables_lines(amount: str, moment: str, grade: bool, expanded: str) -> list[str]:
    """One version of the variables file."""
    fields = [
        ("prd_both", "k", "integer", "basic", "integer"), ("prd_both", "amount", amount, "basic", "*.##"),
        ("prd_both", "moment", "dateTime", "basic", moment), ("prd_both", "remark", "string", "expanded", "asIs"),
        *([("prd_both", "grade", "string", "basic", "asIs")] if grade else []),
        ("prd_basic", "k", "integer", "basic", "integer"), ("prd_expanded", "k", "integer", expanded, "integer"),
        ("prd_absent", "k", "integer", "basic", "integer"),
    ]
    return [_HEAD, *[f"{t},{f},{f} of {t},{d},,{p},{fmt},N," for t, f, d, p, fmt in fields]]


VERSIONS = {
    "early": variables_lines("real", _SECOND, False, "basic"),
    "middle": variables_lines("string", _MINUTE, False, "basic"),
    "late": variables_lines("real", _MINUTE, True, "expanded"),
}
CODES = ["name,code,value", "grades,F,final", "grades,O,open"]
VALIDATION = ["table,fieldName,rule", "prd_both,k,present", "prd_basic,k,present"]
README = ["What this product is.", "And how it was made."]


# Lines that a task sorts and writes at a time.
TASK_LINES = 250_000
# Rows in a file of the staged rows.
FILE_ROWS = 50_000


def staged_rows(spark: SparkSession) -> DataFrame:
    """The rows of the store, written in small files.

    A task that deals lines to their pieces holds all that it read; of a large
    table that is as much as its row groups hold.  Of small files it reads as
    many as the cost of opening one allows, 32 by default, however many there are."""
    return write_once(spark.sql(ROWS_SQL), "rows", max_rows=FILE_ROWS)


def write_lines(lines: DataFrame, files: DataFrame, staged: str, n_lines: int) -> None:
    """Write the ``lines(key, no, line)`` of each of the ``files(key, path)`` to
    its path, in the order of ``no``.

    However long a file, a task holds some of its lines only: they are
    range-partitioned into as many pieces as their number asks for, each piece is
    sorted and written under ``staged`` by its keys, and a file's pieces are then
    copied to its path one behind the other."""
    order = ["key", F.col("no").asc_nulls_last()]
    tasks = max(lines.sparkSession.sparkContext.defaultParallelism, -(-n_lines // TASK_LINES))
    pieces = lines.select("key", "no", "line").repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    pieces.select("key", "line").write.partitionBy("key").option("compression", "none").text(staged)

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, path in zip(pdf["key"], pdf["path"]):
                join_pieces(f"{staged}/key={key}", path)
            yield pdf[["path"]]

    copied = files.select("key", "path").distinct().repartition(lines.sparkSession.sparkContext.defaultParallelism, "key")
    copied.mapInPandas(joined, "path string").write.format("noop").mode("overwrite").save()


def join_pieces(folder: str, path: str) -> None:
    """The part files of a folder, in their order, as one file."""
    filesystem, inner = pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
    parts = [f.path for f in filesystem.get_file_info(pafs.FileSelector(inner)) if f.base_name.startswith("part-")]
    target, to = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    target.create_dir(to.rsplit("/", 1)[0], recursive=True)
    with target.open_output_stream(to) as out:
        for part in sorted(parts, key=lambda p: int(p.rsplit("/", 1)[1].split("-")[1])):
            with filesystem.open_input_stream(part) as piece:
                shutil.copyfileobj(piece, out, 1 << 20)


def write_product_store(spark: SparkSession, sf_dir: str) -> str:
    """Write the store for the tables of ``sf_dir``; returns its root."""
    register_tables(spark, sf_dir)
    root = scratch_path(spark, "product-store")
    root = root if "://" in root else "file://" + root
    rows = staged_rows(spark)
    # which files there are, and of which rows
    places = write_once(rows.select("site", "yr", "mon", "stamp", (F.col("k") % 50 == 0).alias("flagged"), "c7").distinct(), "places")
    stem = F.concat(F.lit("OBS.D01."), F.col("site"), F.lit(".DP1.00002.001."))
    folder = F.concat(F.lit(root + "/main/"), stem, F.col("mon"), F.lit(".expanded."), F.col("stamp"), F.lit(".RELEASE-2024/"))
    parts, files = [], []

    def add(kind: str, path: F.Column, header: F.Column, keep: str, *cells) -> None:
        """The files of a kind, one for each site and year: the header, and the rows to keep."""
        key = F.concat_ws(".", F.lit(kind), "site", "yr").alias("key")
        own = places.filter(keep)
        files.append(own.select(key, path.alias("path")).distinct())
        parts.append(own.select(key, F.lit(-1).cast("long").alias("no"), header.alias("line")).distinct())
        parts.append(rows.filter(keep.replace("flagged", "k % 50 = 0")).select(key, F.col("k").cast("long").alias("no"), F.concat_ws(",", *cells).alias("line")))

    def data(table: str, package: str, header: str, *cells) -> None:
        path = F.concat(folder, stem, F.lit(f"{table}."), F.col("mon"), F.lit(f".{package}."), F.col("stamp"), F.lit(".csv"))
        late = F.col("yr") > 1997
        names = F.lit(header) if "{}" not in header else F.when(late, header.replace("{}", ",grade")).otherwise(header.replace("{}", ""))
        add(f"{table}.{package}", path, names, "true", *cells)

    grade = F.when(F.col("yr") > 1997, F.col("grade"))  # concat_ws leaves a null out
    data("prd_both", "basic", "k,amount,moment{}", F.col("k"), "amount", "moment", grade)
    data("prd_both", "expanded", "k,amount,moment,remark{}", F.col("k"), "amount", "moment", F.concat(F.lit("r"), "c7"), grade)
    data("prd_basic", "basic", "k", F.col("k"))
    data("prd_expanded", "expanded", "k", F.col("k"))
    review = F.concat(folder, stem, F.lit("science_review_flags."), F.col("stamp"), F.lit(".csv"))
    add("science_review_flags", review, F.lit("srfID,lastUpdateDateTime"), "flagged", F.concat(F.lit("F"), F.col("k")), "stamp")

    def lines(texts) -> F.Column:
        return F.array(*[F.struct(F.lit(i).cast("long").alias("no"), F.lit(t).alias("line")) for i, t in enumerate(texts)])

    def beside(kind: str, ending: str, texts: F.Column) -> None:
        path = F.concat(folder, stem, F.lit(kind + "."), F.col("stamp"), F.lit(ending))
        key = F.concat_ws(".", F.lit(kind), "site", "yr").alias("key")
        own = places.select("site", "yr", "mon", "stamp").distinct()
        files.append(own.select(key, path.alias("path")))
        parts.append(own.select(key, F.inline(texts)))

    version = F.when(F.col("yr") <= 1995, lines(VERSIONS["early"])).when(F.col("yr") <= 1997, lines(VERSIONS["middle"])).otherwise(lines(VERSIONS["late"]))
    beside("variables", ".csv", version)
    beside("categoricalCodes", ".csv", lines(CODES))
    beside("validation", ".csv", lines(VALIDATION))
    beside("readme", ".txt", lines(README))

    def sample(product: str, label: str, header: str, keep: str, *cells) -> None:
        where = F.concat(F.lit(f"{root}/frames/OBS.D01."), F.col("site"), F.lit(f".{product}."), F.col("mon"), F.lit(".expanded."), F.col("stamp"), F.lit(f".RELEASE-2024/sample_{label}_a.csv"))
        add(f"{product}.{label}", where, F.lit(header), keep, *cells)

    # of the first product one kind fits its module, the other only the second
    # version of it; the other product's files fit none
    sample("DP1.10081.001", "ITS", "k,abundance", "c7 < 3", F.col("k"), "c7")
    sample("DP1.10081.001", "16S", "abundance,k", "c7 >= 3", F.col("amount"), "k")
    sample("DP1.20190.001", "x", "k,temperature", "c7 = 1", F.col("k"), F.when(F.col("k") % 2 == 0, "warm").otherwise("cold"))
    # a row has a line in four data files, at most two samples and perhaps a review
    write_lines(reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, files), scratch_path(spark, "product-lines"), 6 * rows.count())
    return root


# The frame variables of the modules: the second version of the first module
# reads decimals.
FRAME_VARIABLES = [
    ("MCC", "k", "integer", "integer"), ("MCC", "abundance", "integer", "integer"),
    ("MCC2", "k", "integer", "integer"), ("MCC2", "abundance", "real", "*"),
    ("REA", "k", "integer", "integer"), ("REA", "temperature", "real", "*"),
]

_STORES: dict[tuple, str] = {}


def product_store(spark: SparkSession, sf_dir: str) -> str:
    """The store of ``sf_dir``, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        _STORES[key] = write_product_store(spark, sf_dir)
    return _STORES[key]
