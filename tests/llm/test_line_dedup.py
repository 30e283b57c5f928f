"""Dropped lines against a plain count of line keys, and the index's parts."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.llm import line_dedup as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(L.BLANKS).translate(LOWER)


def brute(rows, min_docs, min_chars=1):
    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= max(1, min_chars))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if held[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(df, min_docs, **kw):
    return sorted((tuple(r) for r in L.drop_shared_lines(df, min_docs, **kw).select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str)


def make(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


ROWS = [(i, f"Header\n\n  body {i % 7}\t\nbody {i}\n HEADER \nÄrger {i % 2}\nsame\nsame") for i in range(40)]
ODD = [(None, None), (1, ""), (1, ""), (2, "\n"), (3, " \t "), (None, "Header"), (3, "header\x0b\nx\r"), (9, "one\n" * 60000 + "header")]


@pytest.mark.parametrize("min_docs,min_chars,block_rows,shard_rows", [(10, 1, 2048, 1 << 18), (6, 1, 3, 5), (6, 7, 7, 9), (1, 1, 16, 16)])
def test_against_plain_count(spark, min_docs, min_chars, block_rows, shard_rows):
    rows = ROWS + ODD
    got = run(make(spark, rows).repartition(3), min_docs, min_chars=min_chars, block_rows=block_rows, shard_rows=shard_rows)
    assert got == brute(rows, min_docs, min_chars)


def test_equal_rows_count_each(spark):
    rows = [(1, "a\nb")] * 9 + [(2, "a\nc")]
    assert run(make(spark, rows), 10) == brute(rows, 10)


def test_empty_table_and_clashing_names(spark):
    assert run(make(spark, []), 2) == []
    df = make(spark, ROWS)
    for c in ("block", "body", "h1", "key", "n_lines", "shard", "n"):
        df = df.withColumn(c, F.lit("given"))
    assert run(df, 6) == brute(ROWS, 6)


def test_hashes_are_spark_s(spark):
    keys = ["", "a", "é€", "x" * 100, "日本語"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", F.xxhash64("k").alias("a"), F.xxhash64(F.lit(1), "k").alias("b"))
    for r in df.collect():
        assert L.key_hashes(r["k"].encode()) == (r["a"] % 2**64, r["b"] % 2**64)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50000])
def test_perfect_hash_is_minimal_and_knows_its_keys(n):
    rng = np.random.default_rng(n)
    first, second = rng.integers(0, 2**64, (2, 2 * n), np.uint64, endpoint=False)
    counts = rng.integers(2, 2**40, n)
    shard = L.Shard.read(L.Shard.of(first[:n], second[:n], counts).row(3))
    assert sorted(shard.hash.slots(first[:n], second[:n])) == list(range(n))
    assert (shard.documents(first[:n], second[:n]) == np.minimum(counts, L.MOST)).all()
    assert (shard.documents(first[n:], second[n:]) == 0).all()
    # keys that share one of the two hashes stay apart
    assert sorted(L.PerfectHash.of(first[:n], second[:n] * 0 + np.uint64(5)).slots(first[:n], second[:n] * 0 + np.uint64(5))) == list(range(n))


def test_arguments(spark):
    with pytest.raises(ValueError):
        L.drop_shared_lines(make(spark, []), 0)
