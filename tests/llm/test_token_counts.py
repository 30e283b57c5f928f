import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from strataframe.llm import token_counts as C
from strataframe.llm.queries import op3

PATH = public_tokenizers.path(C.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_whole_table(spark, tiny, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()}
    got = op3(spark, tiny).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


PARTS = ["the ", "a", " ", "  ", "\n", "hello", "ing", "éé", "日本", "😀", "<s>", "</s>", "<unk>", "▁", "aaaa", "\t", "1234", ".", "...", "\x00", "ﬁ", "tion"]


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (32, 1), (200, 50)])
def test_spliced_chunks_are_exact(library, chunk, overlap):
    counter = C.PieceCounter(PATH, chunk, overlap, chunk)
    rng = random.Random(chunk)
    for _ in range(1500):
        some = rng.choice([PARTS, PARTS[:6], ["a"], ["a", "ab", "aab"], [" "], ["日"], ["ing", "in", "g"]])
        t = "".join(rng.choice(some) for _ in range(rng.randrange(300)))
        assert counter.count(t) == len(library.encode(t)), repr(t)


def test_huge_texts(library):
    counter = C.PieceCounter(PATH)
    for t in ("word " * 60_000, "x" * 120_000 + " y" * 30_000, "日本語 " * 30_000, "\n" * 80_000):
        assert counter.count(t) == len(library.encode(t))


def test_chunks_are_really_spliced(monkeypatch):
    counter = C.PieceCounter(PATH)
    longest = []
    plain = counter.ends
    monkeypatch.setattr(counter, "ends", lambda t, a, b: longest.append(b - a) or plain(t, a, b))
    counter.count("some ordinary words " * 20_000)
    assert len(longest) > 20 and max(longest) == C.CHUNK


def test_nulls_empties_ties_and_names(spark, rows, library):
    pairs = [(1, None), (2, ""), (None, "a b"), (3, " "), (3, " "), (4, "long text " * 20_000)]
    docs = rows(pairs).select("*", *[F.lit(1).alias(n) for n in ("n_tokens", "n_bytes", "over_limit")])
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in C.token_counts(docs).collect())
    want = [(str(i), len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for i, t in pairs]
    assert got == sorted(want)
    assert C.token_counts(rows([])).count() == 0
