import random

import numpy as np
import pandas as pd
import pytest

from strataframe.llm import simhash
from strataframe.llm.queries import op8

from brute import brute_classes, brute_print


def test_golay_keys_meet_for_every_error_of_two_bits():
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**63), 2**63 - 1, 40, dtype=np.int64)
    flips = [np.uint64(1 << a) | np.uint64(1 << b) for a in range(64) for b in range(a + 1)]
    own = simhash.golay_keys(base)
    for flip in flips:
        other = simhash.golay_keys((base.view(np.uint64) ^ flip).view(np.int64))
        met = [(set(a[a >= 0]) & set(b[b >= 0])) for a, b in zip(own, other)]
        assert all(met)


def test_matches_brute_force_on_a_whole_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").toPandas()
    got = op8(spark, tiny).toPandas().sort_values("doc_id").reset_index(drop=True)
    docs = docs.sort_values("doc_id").reset_index(drop=True)
    prints = [brute_print(t) for t in docs.text]
    assert got.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    assert got.component_id.tolist() == brute_classes(prints, docs.doc_id.tolist())


@pytest.mark.parametrize("limit", [2, 16])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_crowded_buckets_link_exactly(spark, limit, bits):
    rng = random.Random(bits)
    prints = set()
    for _ in range(4):
        center = rng.getrandbits(64)
        for _ in range(60):
            p = center
            for _ in range(rng.randrange(5)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    edges = simhash.links(spark.createDataFrame(pd.DataFrame({"fp": signed})), bits, pair_limit=limit).collect()
    for a, b in edges:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= bits
    from strataframe.llm.components import connected_components

    roots = dict(connected_components(spark.createDataFrame(edges or [], "a long, b long")).collect())

    def brute():
        group = {p: p for p in signed}
        changed = True
        while changed:
            changed = False
            for p in signed:
                for q in signed:
                    if bin((p ^ q) & (2**64 - 1)).count("1") <= bits and group[q] < group[p]:
                        group[p] = group[q]
                        changed = True
        return group

    assert {p: roots.get(p, p) for p in signed} == brute()


def test_nulls_empties_ties_and_long_texts(spark, rows):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    pairs = [(5, None), (3, ""), (9, " \t "), (None, "a b c d"), (7, "A b\nc d"), (7, "a b c d"), (1, long), (2, long), (4, "x"), (None, "lonely one here now")]
    got = simhash.near_duplicates(rows(pairs)).collect()
    assert len(got) == len(pairs)
    prints = [brute_print(t) for _, t in pairs]
    want = sorted(zip([str(i) for i, _ in pairs], [f"{p:016x}" for p in prints], map(str, brute_classes(prints, [i for i, _ in pairs]))))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_empty_table_and_clashing_names(spark, rows):
    assert simhash.near_duplicates(rows([])).count() == 0
    from pyspark.sql import functions as F

    docs = rows([(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, "q r s t u")]).select(
        "*", *[F.lit(n).alias(n) for n in ("fp", "key", "root", "component_id", "fingerprint", "row_key", "id", "body", "node")]
    )
    assert simhash.near_duplicates(docs).columns == ["doc_id", "fingerprint", "component_id"]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_keep_one_with_null_and_repeated_ids(spark, rows):
    docs = rows([(None, "a b c d"), (None, "a b c d"), (4, "a b c d"), (None, "p q r s t"), (None, "p q r s t"), (8, None), (8, "")])
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == 3
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 4), (False, 8), (True, 0)]
