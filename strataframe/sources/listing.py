"""List published data files under a folder, as a DataFrame.

Uses the ``binaryFile`` source for its distributed, recursive listing and
selects only ``path``/``length``/``modificationTime`` — the ``content``
column is pruned, so no file body is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators.manifest import parse_file_names

SKIP_DIR = "stackedFiles"


def list_files(spark: SparkSession, root: str, *, glob: str | None = None) -> DataFrame:
    """(path, size, modified) of every file under ``root``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(root)
    return df.select(
        F.col("path"),
        F.col("length").cast("bigint").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def list_data_files(spark: SparkSession, root: str) -> DataFrame:
    """Files whose name ends in ``.`` + three lower-case letters, outside
    any ``stackedFiles`` folder."""
    files = list_files(spark, root)
    keep = F.col("path").rlike(N.DATA_FILE_PATTERN) & ~N.dirname(F.col("path")).contains(SKIP_DIR)
    return files.filter(keep)


def scan_manifest(spark: SparkSession, root: str) -> DataFrame:
    """C2 + C1 + C3: the manifest of a published-file folder."""
    return parse_file_names(list_data_files(spark, root).drop("modified"))
