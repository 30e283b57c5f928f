"""The manifest against a plain Merkle tree built node by node."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from strataframe.llm import merkle
from strataframe.llm.common import crc_bucket

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, fan):
    """(root, sibling runs of each leaf)."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for leaf, i in enumerate(at):
            start = i - i % fan
            paths[leaf].append((level[start:i], level[i + 1 : start + fan]))
        level = [sha(*level[i : i + fan]) for i in range(0, len(level), fan)]
        at = [i // fan for i in at]
    return level[0], paths


def brute(rows, fan=2):
    leaves = {}
    for r in rows:
        did, src, lang, n, text = r
        leaf = sha(enc(did), enc(src), enc(lang), enc(n), enc(text))
        tampered = did is not None and zlib.crc32(str(did).encode()) % 7 == 0
        other = sha(enc(did), enc(src), enc(lang), enc(None if n is None else n + 1), enc(text)) if tampered else leaf
        leaves.setdefault(lang, []).append((did is not None, did or 0, leaf, did, other))
    langs = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    trees = [climb([x[2] for x in sorted(leaves[g], key=lambda x: x[:3])], fan) for g in langs]
    root, tops = climb([t[0] for t in trees], fan) if trees else (None, [])
    out = []
    for g, (sub, paths), top in zip(langs, trees, tops):
        for (_, _, leaf, did, other), path in zip(sorted(leaves[g], key=lambda x: x[:3]), paths):
            whole, at = path + top, other
            for before, after in whole:
                at = sha(*before, at, *after)
            proof = sha(*["".join(b + a) for b, a in whole])
            out.append((did, leaf, sub, root, proof, at, at == root))
    return sorted(out, key=str)


def run(df, **kw):
    out = merkle.document_manifest(df, tampered=crc_bucket("doc_id", 7) == 0, **kw)
    return sorted((tuple(r) for r in out.collect()), key=str)


def make(n):
    langs = [None, "", "de", "en", "en", "en", "é", "z"]
    return [(i, None if i % 5 == 0 else f"s{i % 3}", langs[i * i % 8], None if i % 11 == 0 else i * 3, [None, "", "x\ny", "é€"][i % 4]) for i in range(n)]


@pytest.mark.parametrize("n,fan,depth", [(1, 2, 8), (77, 2, 2), (130, 3, 2)])
def test_against_plain_tree(spark, n, fan, depth):
    rows = make(n)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(3), fan=fan, depth=depth) == brute(rows, fan)


def test_one_group_of_every_size_around_a_block(spark):
    for n in (4, 5, 17):
        rows = [(i, "s", "en", i, f"t{i}") for i in range(n)]
        assert run(spark.createDataFrame(rows, SCHEMA), depth=2) == brute(rows)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None)] * 2 + [(7, "a", "en", 1, "x")] * 3 + [(7, "b", "en", 2, "y"), (None, "c", "en", 3, "z" * 300000)]
    assert run(spark.createDataFrame(rows, SCHEMA), depth=1) == brute(rows)


def test_only_tampered_rows_fail(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    out = merkle.document_manifest(docs, tampered=crc_bucket("doc_id", 7) == 0)
    wrong = {r["doc_id"] for r in out.filter(~F.col("verified")).collect()}
    known = docs.where("n_chars is not null").select("doc_id").collect()
    assert wrong == {r[0] for r in known if zlib.crc32(str(r[0]).encode()) % 7 == 0} and wrong


def test_empty_table_and_clashing_names(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    rows = make(9)
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("leaf", "root", "grp", "node", "pos", "n", "segments", "other", "_at"):
        df = df.withColumn(c, F.lit("given"))
    assert run(df) == brute(rows)


def test_arguments(spark):
    with pytest.raises(ValueError):
        merkle.document_manifest(spark.createDataFrame([], SCHEMA), fan=1)
