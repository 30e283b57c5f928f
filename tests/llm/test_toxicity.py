import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.llm import toxicity as X
from strataframe.llm.queries import op1


def labels_of(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(8)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = X.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == (got.score >= 0.5)).all()
    assert got.score.between(0, 1).all()
    toxic = got[got.toxic == 1]
    # one toxic label in ten or so is noise on texts like any other
    assert toxic.predicted.mean() > 0.85
    assert got[got.toxic == 0].predicted.mean() < 0.02


def test_query_covers_the_table_and_marks_held_out_rows(spark, tiny):
    got = op1(spark, tiny).toPandas()
    ids = [r.doc_id for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id").collect()]
    assert sorted(got.doc_id) == sorted(ids)
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out))


def test_only_text_and_allowed_labels_decide(spark, rows):
    texts = [(i, "you are a moron today" if i % 2 else "what a fine day today") for i in range(60)]
    right = labels_of(spark, [(i, i % 2) for i in range(60)])
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    wrong = labels_of(spark, [(i, (i + (i in held)) % 2) for i in range(60)])
    a = {r.doc_id: r.score for r in X.classify(rows(texts), right).collect()}
    b = {r.doc_id: r.score for r in X.classify(rows(texts), wrong).collect()}
    assert a == b
    assert all((s >= 0.5) == bool(i % 2) for i, s in a.items())
    assert len({round(a[i], 12) for i in a if i % 2}) == 1


def bias_fixture():
    toxic = [f"the muslims are awful scum number {w}" for w in "one two three four five six".split()] * 4
    clean = [f"the christians are lovely folk number {w}" for w in "one two three four five six".split()] * 4
    return toxic, clean


def fitted(penalty):
    toxic, clean = bias_fixture()
    texts, y = toxic + clean, np.array([1.0] * len(toxic) + [0.0] * len(clean))
    names = sorted({f for t in texts for w in X.words_of(t) for f in X.features_of(w)})
    columns = {f: k for k, f in enumerate(names)}
    x = np.stack([X.densities(X.words_of(t), columns) for t in texts])
    pairs = [p for t in texts for p in X.counterfactuals(t)]
    changes = np.stack([X.densities(a, columns) - X.densities(b, columns) for a, b in pairs])
    return X.fit(x, y, changes, columns, penalty)


def test_counterfactual_penalty_frees_neutral_mentions():
    gap, mention = [], []
    for penalty in (0.0, 4.0):
        model = fitted(penalty)
        a, b, slur = model.scores(["the muslims live here", "the christians live here", "awful scum"], {})
        gap.append(abs(a - b))
        mention.append(a)
        assert slur > 0.5
    assert gap[1] < 0.1 * gap[0]
    assert mention[1] < mention[0]


def test_swaps_keep_the_rest():
    pairs = X.counterfactuals("Gay men came. Nobody else.\nDie Frauen auch")
    assert len(pairs) == len(X.IDENTITY_TERMS[0]) - 1 + len(X.IDENTITY_TERMS[1]) - 1
    swapped = {b[0] for a, b in pairs if a[0] == "gay"}
    assert swapped == set(X.IDENTITY_TERMS[0]) - {"gay"}
    assert all(len(a) == len(b) and a != b for a, b in pairs)
    assert X.counterfactuals("") == []


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0)], [(1, None), (None, 1)]])
def test_unusable_labels(spark, rows, labels):
    got = X.classify(rows([(1, "a b"), (2, None), (None, ""), (2, "x" * 100_000), (2, "x" * 100_000)]), labels_of(spark, labels)).collect()
    assert len(got) == 5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True]


def test_empty_texts_empty_table_and_clashing_names(spark, rows):
    texts = [(i, "vile moron" if i % 2 else "kind soul") for i in range(40)] + [(100, None), (101, ""), (102, "12 !!")]
    labels = labels_of(spark, [(i, i % 2) for i in range(40)] + [(3, 0), (3, 1)])
    docs = rows(texts).select("*", *[F.lit("z").alias(n) for n in ("score", "body", "toxic", "label_id", "toxicity", "held_out")])
    got = {r.doc_id: r for r in X.classify(docs, labels).collect()}
    assert [got[i].predicted for i in (100, 101, 102)] == [0, 0, 0]
    kept = X.clean_documents(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(0, 40, 2), 100, 101, 102]
    assert X.classify(rows([]), labels).count() == 0
    assert X.clean_documents(rows([]), labels).count() == 0


def test_driver_gets_one_sum_of_all_counterfactuals(spark, rows, monkeypatch):
    def body(i):
        return " ".join(f"The {'muslims are awful scum' if i % 2 else 'women are kind folk'}." for _ in range(50))

    texts = [(i, body(i)) for i in range(40)]
    got = []
    frame = type(spark.range(0))
    for name in ("toPandas", "collect"):
        monkeypatch.setattr(frame, name, lambda self, own=getattr(frame, name): got.append(own(self)) or got[-1])
    X.learn(rows(texts), labels_of(spark, [(i, i % 2) for i in range(40)]))
    assert max(map(len, got)) < 200  # the sentences have thousands of copies


def test_sum_of_counterfactuals_is_the_dense_product(spark, monkeypatch):
    bodies = [f"The women and gay men number {i} came. Die Frauen und Juden! No one. The black cat, the white dog" for i in range(30)]
    columns = {f: k for k, f in enumerate(sorted({f for b in bodies for w in X.words_of(b) for f in X.features_of(w)}))}
    dense = np.stack([X.densities(a, columns) - X.densities(b, columns) for t in bodies for a, b in X.counterfactuals(t)])
    grams = []
    for parts in (1, 5):
        drawn = spark.createDataFrame([(b, 0) for b in bodies], "body string, toxic int").repartition(parts)
        gram, n = X.gram_of(drawn, columns)
        assert n == len(dense)
        assert np.allclose(gram, dense.T @ dense, rtol=1e-5, atol=1e-3)
        grams.append(gram)
    assert (grams[0] == grams[1]).all()


def test_a_lexicon_of_rare_words_is_learnt_whole(spark, rows):
    """300 toxic words, each in 20 of 6,000 toxic texts and in no clean one."""
    rng = np.random.default_rng(7)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))

    def word(n):
        return "".join(rng.choice(letters, n))

    common, toxic = [word(6) for _ in range(400)], ["zz" + word(7) for _ in range(300)]
    texts = []
    for i in range(12_000):
        said = list(rng.choice(common, 30)) + ([toxic[i // 2 % 300]] if i % 2 else [])
        texts.append((i, " ".join(rng.permutation(said))))
    model = X.learn(rows(texts), labels_of(spark, [(i, i % 2) for i in range(12_000)]))
    fresh = [" ".join([*rng.choice(common, 29), w]) for w in toxic] + [" ".join(rng.choice(common, 30)) for _ in range(300)]
    found = model.scores(fresh, {}) >= 0.5
    assert found[:300].all() and not found[300:].any()


def test_sparse_steps_solve_the_dense_problem():
    rng = np.random.default_rng(3)
    x = rng.random((60, 8)) * (rng.random((60, 8)) < 0.3)
    y = (x[:, 0] + x[:, 1] > 0.6).astype(float)
    model = X.fit(x, y, x[:5] - x[5:10], {str(k): k for k in range(8)}, ridge=1e-2)
    w, d = np.array([model.weights[str(k)] for k in range(8)]), x[:5] - x[5:10]
    p = 1 / (1 + np.exp(-(x @ w + model.bias)))
    weigh = np.where(y > 0, 0.5 / y.sum(), 0.5 / (60 - y.sum()))
    gradient = x.T @ (weigh * (p - y)) + 1e-2 * w + 2 * 4.0 / 5 * d.T @ d @ w
    assert np.abs(gradient).max() < 1e-4


def test_whole_result_by_brute_force(spark, tiny):
    """Every score of the table from the model's weights, in plain loops."""
    import math
    import re

    docs, labels = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    model = X.learn(docs, labels, held)
    got = {r.doc_id: r for r in X.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        words = re.findall(r"[^\W\d_]+", (r.text or "").lower())
        count = {}
        for w in words:
            for f in ["=" + w] + ["^" + w[:k] for k in (5, 6, 7) if len(w) >= k]:
                count[f] = count.get(f, 0) + 1
        z = model.bias + sum(model.weights.get(f, 0.0) * math.sqrt(100 * n / len(words)) for f, n in count.items())
        p = 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))
        want = p if words else min(p, 0.49)
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].predicted == int(want >= 0.5)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
