"""Small helpers the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.session import prepare, scratch_path

#: The ASCII letters a contract lower-cases.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


#: A table is broadcast only if a count of its bytes stays below this.
BROADCAST_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; every read goes through Spark's own file reader."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read, not a
    recomputation, and keeps a result that is used twice from being made
    twice."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows one, otherwise
    as it is, for an ordinary shuffled join."""
    size = df.agg(F.sum(F.length(column) + 32)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def text_or_empty(column: str = "text") -> Column:
    """The text as a string, null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that the input can't already hold (compared
    as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def row_digest(df: DataFrame) -> Column:
    """A 128-bit digest of all columns, null and empty told apart."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in df.columns]
    return F.md5(F.concat_ws("\u0000", *parts).cast("binary"))


def crc_bucket(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus
