import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strataframe.llm import quality_rules as Q
from strataframe.llm.queries import op4


def brute(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    inside = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            lines += line in seen
            seen.add(line)
    n = len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (n, sum(map(len, words)), symbols, lines, len(inside), n < 50 or 100 * len(inside) > 50 * n)


def base(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_base_columns_of_a_whole_table(spark, tiny):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()}
    got = op4(spark, tiny).collect()
    assert len(got) == len(texts)
    assert all(base(r) == brute(texts[r.doc_id]) for r in got)
    assert not any(r.base_failed and r.kept for r in got)


def test_verdicts_against_the_labels(spark):
    """The model never sees the labels of quality; they only judge it here."""
    sf = "/root/testdata/sf0.1"
    got = Q.judge(spark.read.parquet(f"{sf}/documents.parquet").repartition(8))
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id").toPandas()
    passed = both[~both.base_failed]
    assert passed[passed.label == 1].kept.mean() > 0.99
    assert passed[passed.label == 0].kept.mean() < 0.05


def test_verdicts_match_a_plain_run(spark, tiny):
    """The same expectation-maximisation on votes that were not counted."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()}
    votes = {i: Q.measures(t or "")[1] for i, t in texts.items()}
    passed = [votes[i] for i in texts if not brute(texts[i])[-1]]
    from strataframe.llm.label_model import LabelModel

    model = LabelModel(len(Q.RULES), prior=0.7, smoothing=5.0).fit(np.array(passed), np.ones(len(passed)))
    for r in op4(spark, tiny).collect():
        p = model.posterior([votes[r.doc_id]])[0]
        assert abs(r.quality - p) < 1e-6
        assert r.kept == (not r.base_failed and r.quality >= 0.5)


def test_repeated_windows_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(500):
        words = [b"abcd"[k : k + 1] for k in rng.integers(0, 4, rng.integers(0, 14))]
        assert Q.repeated_words(words) == brute(b" ".join(words).decode())[4]


def test_nulls_empties_ties_long_texts_and_names(spark, rows):
    long = "\n".join(f"line {k % 5000} of a very long text." for k in range(60_000))
    pairs = [(1, None), (2, ""), (None, " \n\t"), (3, "a\nb\na\n \n "), (3, "a\nb\na\n \n "), (4, long), (5, "é\x1fß # 日本")]
    docs = rows(pairs).select("*", *[F.lit(1).alias(n) for n in ("votes", "quality", "n_words", "m", "kept")])
    got = sorted((str(r.doc_id), *base(r)) for r in Q.judge(docs).collect())
    assert got == sorted((str(i), *brute(t)) for i, t in pairs)
    assert Q.judge(rows([])).count() == 0
