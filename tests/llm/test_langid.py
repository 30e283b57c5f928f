import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.llm import langid as L
from strataframe.llm.queries import op10


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(8)
    got = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert got.score.between(0, 1).all()


def test_query_covers_the_table(spark, tiny):
    got = op10(spark, tiny).collect()
    assert len(got) == spark.read.parquet(f"{tiny}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_viterbi_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = rng.integers(0, 6, rng.integers(1, 6))
        scores = rng.normal(0, 3, (lengths.sum(), 3)).astype(np.float32)
        penalty = float(rng.uniform(0, 5))
        labels = L.viterbi(scores, lengths, penalty)
        at = 0
        for n in lengths:
            part = scores[at : at + n]

            def value(path):
                return sum(part[k, x] for k, x in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))

            if n:
                best = max(map(value, itertools.product(range(3), repeat=int(n))))
                assert abs(value(labels[at : at + n]) - best) < 1e-3
            at += n


def learned(spark):
    rng = random.Random(1)
    made = {"en": "the of and to in is was that for with", "de": "der die und das ist nicht ein zu von mit", "ru": "и в не на что с по это как из"}
    data = [(l, " ".join(rng.choice(w.split()) for _ in range(60))) for l, w in made.items() for _ in range(10)]
    return L.learn(spark.createDataFrame(data, "lang string, text string"))


def test_spans_of_mixed_texts(spark, rows):
    model = learned(spark)
    english, german = "the of and to in is was that for with", "der die und das ist nicht ein zu von mit"
    texts = [(1, english + " " + german), (2, english + " und " + english), (3, "это как из"), (4, english + ". это как из не на! " + german), (5, "漢字"), (6, "1 2 3"), (7, None)]
    got = {r.doc_id: r.lang_spans for r in L.spans(rows(texts), model).collect()}
    n = len(english)
    assert got[1] == f"en:0:{n},de:{n + 1}:{n + 1 + len(german)}"
    assert got[2] == f"en:0:{2 * n + 5}"
    assert got[3] == "ru:0:10"
    assert [x.split(":")[0] for x in got[4].split(",")] == ["en", "ru", "de"]
    assert got[5].endswith(":0:2") and got[6] == "" and got[7] == ""


def test_words_and_slices_by_brute_force(monkeypatch):
    import re

    monkeypatch.setattr(L, "SLICE", 7)
    rng = random.Random(9)
    for _ in range(300):
        t = "".join(rng.choice("abÉ 1.\n日я́İ😀") for _ in range(rng.randrange(40)))
        found = [(int(a) , int(b)) for base, part in L._slices(t) for a, b in zip(*L.words_and_grams(part, base)[:2])]
        assert found == [m.span() for m in re.finditer(r"[^\W\d_]+", t)]


@pytest.mark.parametrize("langs", [[None, None, None], ["en", None, "xx"]])
def test_little_to_learn_from(spark, langs):
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(zip(["a b", None, ""], langs))], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    assert (got[1].lang_pred, got[1].score, got[2].lang_pred) == ("und", 0.0, "und")
    assert got[0].lang_pred in ("en", "xx", "und")


def test_ties_long_texts_names_and_empty_table(spark):
    base = [(i, "the cat and the dog" if i % 2 else "le chat et le chien", "en" if i % 2 else "fr") for i in range(40)]
    base += [(None, "the dog", "en"), (7, "the cat " * 60_000, "en"), (7, "12 34 ..", "en")]
    docs = spark.createDataFrame(base, "doc_id long, text string, lang string")
    docs = docs.select("*", *[F.lit("z").alias(n) for n in ("score", "lang_pred", "body", "t", "l", "bucket")])
    got = L.identify(docs).collect()
    assert len(got) == len(base)
    assert sorted(r.lang_pred for r in got if r.doc_id == 7) == ["en", "en", "und"]
    assert [(r.held_out, r.lang_pred) for r in got if r.doc_id is None] == [(True, "en")]
    assert L.identify(docs.limit(0)).count() == 0


def test_labels_of_held_out_rows_are_never_read(spark):
    rows = [(i, "alpha beta" if i % 2 else "uno dos", "a" if i % 2 else "b") for i in range(60)]
    other = [(i, t, "c" if zlib.crc32(str(i).encode()) % 4 == 2 else l) for i, t, l in rows]
    schema = "doc_id long, text string, lang string"
    a, b = (sorted(map(tuple, L.identify(spark.createDataFrame(x, schema)).collect())) for x in (rows, other))
    assert a == b


def brute_identify(rows):
    """Counts, paths and answers in plain loops."""
    import math
    import unicodedata

    def low(c):
        return ord(c.lower()) if len(c.lower()) == 1 else ord(c)

    def words(t):
        out, at = [], 0
        while at < len(t):
            end = at
            while end < len(t) and unicodedata.category(t[end])[0] == "L":
                end += 1
            if end > at:
                grams = []
                for i in range(at, end):
                    a, b, c = (low(t[k]) if 0 <= k < len(t) and unicodedata.category(t[k])[0] == "L" else 32 for k in (i - 1, i, i + 1))
                    g = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0x7FFFFFFFFFFF
                    grams.append((g ^ (g >> 17)) % L.BUCKETS)
                out.append((at, end, int(L._letters()[ord(t[at])]) - 1, grams))
            at = max(end, at + 1)
        return out

    grams, scripts = {}, {}
    for i, t, lang in rows:
        if lang is not None and i is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            own, kinds = grams.setdefault(lang, {}), scripts.setdefault(lang, {})
            for s, e, k, found in words(t or ""):
                kinds[k] = kinds.get(k, 0) + e - s
                for g in found:
                    own[g] = own.get(g, 0) + 1
    names = sorted(grams)
    total = {x: sum(grams[x].values()) for x in names}

    def word_score(x, word):
        # what 32-bit tables hold
        own = [np.float32(math.log(grams[x].get(g, 0) + 0.5) - math.log(total[x] + 0.5 * L.BUCKETS)) for g in word[3]]
        return float(np.add.reduce(np.array(own, dtype=np.float32)))

    def allowed(k):
        fits = [x for x in names if scripts[x].get(k, 0) > 0 and scripts[x][k] >= L.LEAST_SHARE * sum(scripts[x].values())]
        return fits or names

    out = []
    for i, t, _ in rows:
        found = words(t or "")
        if not found or not names:
            out.append((i, "und", 0.0))
            continue
        best, back = None, []
        for w in found:
            raw = {x: word_score(x, w) for x in names}
            fits = allowed(w[2])
            here = {x: raw[x] if x in fits else min(raw.values()) + L._FAR for x in names}
            if best is None:
                best = here
                continue
            top = max(names, key=lambda x: best[x])
            back.append({x: x if best[x] >= best[top] - L.PENALTY else top for x in names})
            best = {x: max(best[x], best[top] - L.PENALTY) + here[x] for x in names}
        path = [max(names, key=lambda x: best[x])]
        for step in reversed(back):
            path.append(step[path[-1]])
        letters = {}
        for x, (s, e, *_) in zip(reversed(path), found):
            letters[x] = letters.get(x, 0) + e - s
        lang = max(names, key=lambda x: letters.get(x, 0))
        out.append((i, lang, letters[lang] / sum(letters.values())))
    return sorted(out, key=str)


def test_whole_result_by_brute_force(spark):
    said = {"en": "the cat and a dog went over there", "de": "die Katze und ein Hund gingen über Straßen", "fr": "le chat et un chien été là", "ru": "кошка и собака шли"}
    rng = random.Random(4)
    rows = []
    for i in range(80):
        lang = rng.choice(list(said))
        parts = [" ".join(rng.choices(said[x].split(), k=rng.randrange(1, 9))) for x in (lang, rng.choice(list(said)) if i % 5 == 0 else lang)]
        rows.append((i if i % 17 else None, rng.choice([", ", " 12 ", "\n"]).join(parts) if i % 13 else None, lang if i % 7 else None))
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()), key=str)
    want = brute_identify(rows)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, want))
