"""Answers against a plain ranking of all documents, item by item."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataframe.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top):
    counts = [(d, Counter(terms_of(t)), len(terms_of(t))) for d, t in docs if terms_of(t)]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms_of(t))
    out = []
    for i, own in wanted.items():
        scored = []
        for d, c, n in counts:
            m = 50 + 50 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(i, k, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, top=5, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in L.search(d, q, top, **kw).select("item_id", "rank", "doc_id", "score").collect()), key=str)


WORDS = ["the", "The", "a", "b7", "naïve", "ÄB", "é", "日本", "x-y", "c++", "of", "rare1", "rare2", "U.S.", "_z_", " w "]


def corpus(n, seed):
    r = random.Random(seed)
    return [(i, r.choice(["\n", " ", "; ", "\t\x0b"]).join(r.choices(WORDS, k=r.randrange(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [L.BLOCK_BYTES, 20])
def test_against_plain_ranking(spark, block_bytes):
    docs, items = corpus(120, 1), [(i * 3, t) for i, t in corpus(9, 2)] + [(100, "zzz unseen"), (101, "")]
    assert run(spark, docs, items, block_bytes=block_bytes) == brute(docs, items, 5)


def test_ties_copies_nulls_and_repeats(spark):
    docs = [(i, "alpha beta alpha") for i in range(40)] + [(None, "alpha beta alpha"), (3, "alpha beta alpha"), (50, None), (51, ""), (52, ";;")]
    docs += [(60, "alpha " * 200_000), (61, "gamma"), (62, "alphabet")]
    items = [(1, "Alpha"), (1, "gamma"), (None, "beta beta"), (2, None), (4, "gamma"), (4, "gamma")]
    assert run(spark, docs, items, 7) == brute(docs, items, 7)


def test_pieces_of_a_batch(monkeypatch, spark):
    monkeypatch.setattr(L, "CELLS", 7)
    docs, items = corpus(60, 3), corpus(6, 4)
    scorer_rows = run(spark, docs, items)
    assert scorer_rows == brute(docs, items, 5)


def test_terms_share_their_guards():
    found = L.automaton(["a", "b c", "é"])
    n, tf = L.count_terms(found, "a a,A  é(a) éa".encode())
    assert n == 6 and dict(tf) == {0: 4, 2: 1}


def test_empty_tables_and_clashing_names(spark):
    docs, items = corpus(20, 5), corpus(4, 6)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("terms", F.lit(1)).withColumn("n", F.lit(2))
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(9)).withColumn("term", F.lit("t")).withColumn("score", F.lit(1))
    got = sorted((tuple(r) for r in L.search(d, q, 5).collect()), key=str)
    assert got == brute(docs, items, 5)
