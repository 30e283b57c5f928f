import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataframe.llm import bpe
from strataframe.llm.queries import op5


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def own():
    return bpe.ForcedBoundaries(public_tokenizers.path(bpe.VOCABULARY))


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


def digests(library, text):
    n, ids, decoded = expected(library, text)
    return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_whole_table(spark, tiny, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()}
    got = op5(spark, tiny).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, texts[r.doc_id])


def test_random_texts(own, library):
    rng = random.Random(5)
    parts = ["a", "B", "é", "É", "'s", "'S", "'", "<|endoftext|>", "<|", "|>", " ", "\n", "\t", "\r", "\xa0", "\x1c", " ", "3", "."]
    parts += [",", "!!", "́", "̸", "<", "=", "İ", "ß", "ﬁ", "한", "ᄒ", "ᅡ", "日", "😀", "‍", "don't", "x.y", "\x00", "Σ", "…", "the", ".,;"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert own.encode(t) == expected(library, t), repr(t)


def test_no_forced_pair_stands_inside_a_token(own, library):
    inside = {}
    for token, _ in library.get_vocab().items():
        for sign in own.cut_signs:
            if token not in own.special and sign in (bare := token.removesuffix("</w>")):
                inside.setdefault(sign, []).append(bare)
    for sign, tokens in inside.items():
        assert not any(t[k - 1].isascii() and t[k - 1].isalpha() for t in tokens for k in range(1, len(t)) if t[k] == sign)
    assert {",", "."} <= set(own.cut_signs) and "'" not in own.cut_signs


def test_a_full_store_changes_nothing(library, monkeypatch):
    small = bpe.ForcedBoundaries(public_tokenizers.path(bpe.VOCABULARY))
    monkeypatch.setattr(bpe, "KEPT_FRAGMENTS", 5)
    for t in ("one two three", "two three four five six, seven", "one nine", "a b c d e f g h i j", "x" * 500 + " one"):
        assert small.encode(t) == expected(library, t)


def test_nulls_empties_ties_long_texts_and_names(spark, rows, library):
    pairs = [(1, None), (2, ""), (None, " \n"), (3, "Hello, World"), (3, "Hello, World"), (4, "no white space " * 40_000), (5, "ab" * 50_000)]
    docs = rows(pairs).select("*", *[F.lit("z").alias(n) for n in ("n_tokens", "d", "bpe", "ids", "decoded")])
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.token_digests(docs).collect())
    assert got == sorted((str(i), *digests(library, t)) for i, t in pairs)
    assert bpe.token_digests(rows([])).count() == 0


def test_ids_and_round_trip(spark, rows, library):
    pairs = [(1, None), (2, "Hello <|endoftext|> it's 42!"), (3, "")]
    coded = bpe.encode_texts(rows(pairs)).select("doc_id", "bpe.*")
    back = {r.doc_id: r for r in bpe.decode_ids(coded, out="again").collect()}
    for i, t in pairs:
        n, ids, decoded = expected(library, t)
        assert (back[i].n_tokens, " ".join(map(str, back[i].ids)), back[i].decoded, back[i].again) == (n, ids, decoded, decoded)


def test_cuts_inside_runs(own, library):
    assert own.fragments("abc12.5,x don't l'été! (é)7a") == ["abc", "1", "2", ".", "5", ",", "x", "don", "'t", "l", "'été", "!", "(", "é)", "7", "a"]
    assert own.fragments("a<|endoftext|>b x<|y1") == ["a", "<|endoftext|>b", "x", "<|y1"]
    assert own.fragments("ΑΣ.b3 日本1") == ["ΑΣ.b3", "日本1"]
    for table, letters in ((own.table.after_letter, "after"), (own.table.before_letter, "before")):
        assert {ord("."), ord(","), ord("7")} <= set(table), letters
    assert ord("'") not in own.table.before_letter


def test_random_runs_of_letters_digits_and_signs(own, library):
    rng = random.Random(11)
    letters = "abzABZéÉßÿÀøØ'ST" + "0123456789" + "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    for _ in range(20_000):
        t = "".join(rng.choice(letters + " ") for _ in range(rng.randrange(1, 16)))
        assert own.encode(t) == expected(library, t), repr(t)


def test_a_vocabulary_that_joins_signs_is_not_cut_there():
    pairs = {(ord("a"), ord(".")), (0xA9, ord("3")), (ord("-"), 0xC3), (ord("1"), ord("2"))}
    table = bpe.CutTable(pairs, ["<|x|>"])
    assert table.split("b.c") == ["b.", "c"] and table.split("b3") == ["b", "3"] and table.split("3b") == ["3", "b"]
    assert table.split("b-c") == ["b", "-", "c"] and table.split("b-é") == ["b", "-é"] and table.split("é3b") == ["é3", "b"] and table.split("12") == ["12"] and table.split("b<|x|>") == ["b<|x|>"]
