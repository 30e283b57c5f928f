"""A corpus pipeline: documents in, token digests of the clean ones out.

Each stage calls one operator of ``strataframe.llm`` on all that the stage
before it kept.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataframe.llm import bpe, decontaminate, pii, simhash, toxicity
from strataframe.llm.common import materialize, read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.clean_documents(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages by the contamination rule go."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.token_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("bpe", encode),
]

#: Trained models and the tokenizer can't be said in SQL; the tests hold the
#: pipeline against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
