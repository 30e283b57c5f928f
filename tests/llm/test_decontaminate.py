import hashlib
import re

import pytest
from pyspark.sql import functions as F

from strataframe.llm import common
from strataframe.llm import decontaminate as D
from strataframe.llm.queries import op7

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (t := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= {x for x in windows[t] if x is not None}
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def items_frame(spark, pairs):
    return spark.createDataFrame(pairs, "item_id long, text string")


def test_whole_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{tiny}/benchmark.parquet").select("item_id", "text").collect()
    assert result(op7(spark, tiny)) == brute(docs, items)


LONG = " ".join(f"t{i}" for i in range(40))


@pytest.mark.parametrize("size", [1, 2, 13])
def test_edges(spark, rows, size):
    docs = [
        (1, None), (2, ""), (3, "-- !"), (None, "x " + LONG), (4, LONG.upper() + " tail"), (4, LONG), (5, "the the the the"),
        (6, "solo"), (7, "Éa b SOLO. the, the"), (8, " ".join(["pad"] * 3000) + " " + LONG), (9, "t0 t1 t2"), (9, "t0 t1 t2"),
    ]
    items = [(10, LONG), (2, LONG), (10, LONG), (3, "the the"), (4, "solo"), (None, "pad"), (5, None), (6, ""), (7, "never seen words")]
    assert result(D.contamination(rows(docs), items_frame(spark, items), size)) == brute(docs, items, size)


def test_shuffled_sides_give_the_same(spark, rows, monkeypatch):
    docs = [(i, f"a{i} " + LONG if i % 3 else "other words") for i in range(9)]
    items = [(1, LONG), (2, "other words")]
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert result(D.contamination(rows(docs), items_frame(spark, items))) == brute(docs, items)


def test_empty_tables_and_clashing_names(spark, rows):
    some = rows([(1, "a b")])
    assert D.contamination(rows([]), items_frame(spark, [(1, "a")])).count() == 0
    assert result(D.contamination(some, items_frame(spark, []))) == brute([(1, "a b")], [])
    clash = some.select("*", *[F.lit("z").alias(n) for n in ("text_key", "term", "pos", "words", "n_words", "items", "spans")])
    items = items_frame(spark, [(1, "a")]).select("*", F.lit("z").alias("terms"), F.lit("z").alias("window_id"))
    assert result(D.contamination(clash, items)) == brute([(1, "a b")], [(1, "a")])
    assert D.clean_documents(clash, items).count() == 0
    assert D.clean_documents(clash, items_frame(spark, [])).columns == clash.columns


def test_proximity(spark, rows):
    docs = [(1, "a x x b x c"), (2, "c b a"), (3, "a " + "x " * 30 + "b c"), (4, "a b"), (5, "q")]
    items = items_frame(spark, [(1, "a b c"), (2, "q")])
    phrases = D.windows_of(items).select("window_id", "terms").distinct()
    index = D.positional_index(rows(docs), phrases.select(F.explode("terms").alias("term")).distinct())
    near = D.proximity_matches(index, phrases, 5).select("text_key").distinct()
    keys = rows(docs).select("doc_id", D.text_key().alias("text_key"))
    assert sorted(r.doc_id for r in keys.join(near, "text_key").collect()) == [1, 2, 5]
    with pytest.raises(ValueError):
        D.proximity_matches(index, phrases, 0)


def test_slots_are_ranked_alike_without_a_broadcast(spark, monkeypatch, rows):
    docs = rows([(i, f"the the quick brown fox {i} of the lazy dogs the end") for i in range(20)])
    items = spark.createDataFrame([(1, "the quick brown fox"), (2, "of the lazy"), (3, "the"), (4, "no such words")], "item_id long, text string")
    got = []
    for limit in (D.BROADCAST_BYTES, 0):
        monkeypatch.setattr(D, "BROADCAST_BYTES", limit)
        got.append(sorted(map(str, D.contamination(docs, items, size=3).drop("text_key").collect())))
    assert got[0] == got[1] and "n_hit=" in got[0][0]
