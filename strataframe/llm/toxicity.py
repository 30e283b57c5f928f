"""A toxicity classifier with counterfactual regularisation.

Logistic regression on the root of the density of words and word beginnings.  Each labelled
sentence that names a group is paired with copies in which the group's name is
swapped for another's; the loss adds the squared change of the score between a
sentence and its copies.  What distinguishes the copies is only the identity
term, so its weights shrink towards each other and towards zero, and a neutral
mention of a group no longer pushes a text over the threshold.

The model is fitted on a bounded sample of labelled rows (``max_rows``, the
smallest digests of the ids in each class, so the same rows are drawn however
the table is split); the scores cover every text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_bucket, materialize

#: Names of groups, by language, swapped for one another.
IDENTITY_TERMS = (
    ("women", "men", "muslims", "christians", "jews", "hindus", "immigrants", "gay", "lesbian", "straight", "black", "white", "asian", "african", "arab", "trans", "deaf", "disabled"),
    ("frauen", "männer", "muslime", "christen", "juden", "einwanderer", "schwule", "lesben", "schwarze", "weiße", "asiaten"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "gays", "lesbiennes", "noirs", "blancs"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "negros", "blancos"),
)
_GROUP_OF = {term: terms for terms in IDENTITY_TERMS for term in terms}
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]?")
#: Lengths of the word beginnings that are features beside whole words.
BEGINNINGS = (5, 6, 7)
#: Words whose weights a Python worker keeps; beyond it the store starts anew.
KEPT_WORDS = 400_000
#: Features that a task counts before it hands its counts on.
COUNTED_FEATURES = 100_000
#: Changes (at most 10) are counted in units of 2^-20, and a task
#: hands on its sum after so many: it stays below 2^63.
GRAM_UNIT = 1 << 20
GRAM_ROWS = 50_000


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features_of(word: str) -> list[str]:
    """The word, and its beginnings if it is long enough."""
    return ["=" + word] + ["^" + word[:k] for k in BEGINNINGS if len(word) >= k]


def density_of(words: list[str], columns: dict[str, int]) -> dict[int, float]:
    """Of the features in ``columns`` that occur: the square root of their
    number per hundred words, so that a few marked words still show in a long
    text."""
    found: Counter = Counter()
    for w, n in Counter(words).items():
        for f in features_of(w):
            if (k := columns.get(f)) is not None:
                found[k] += n
    return {k: math.sqrt(n * 100.0 / len(words)) for k, n in found.items()}


def densities(words: list[str], columns: dict[str, int]) -> np.ndarray:
    """``density_of`` with a place for each of the ``columns``."""
    out = np.zeros(len(columns))
    for k, v in density_of(words, columns).items():
        out[k] = v
    return out


#: The features that swapping names can change.
IDENTITY_FEATURES = frozenset(f for term in _GROUP_OF for f in features_of(term))


def counterfactuals(text: str) -> list[tuple[list[str], list[str]]]:
    """Pairs of a sentence's words and the same words with identity terms
    swapped: one for each other name of the longest list that a term is from,
    every term moving on by as many places in its own list."""
    pairs = []
    for sentence in _SENTENCE.findall(text):
        words = words_of(sentence)
        names = max((len(_GROUP_OF[w]) for w in words if w in _GROUP_OF), default=0)
        for k in range(1, names):
            pairs.append((words, [_swap(w, k) for w in words]))
    return pairs


def _swap(word: str, step: int) -> str:
    names = _GROUP_OF.get(word)
    return names[(names.index(word) + step) % len(names)] if names else word


@dataclass
class ToxicityModel:
    """A weight for each chosen feature, and a bias."""

    weights: dict[str, float]
    bias: float

    def scores(self, texts, store: dict[str, tuple[str, ...]]) -> np.ndarray:
        """Scores of texts; ``store`` keeps the weighted features of words seen
        before, none for most."""
        weights = self.weights
        out = np.full(len(texts), self.bias)
        for k, text in enumerate(texts):
            words = words_of(text or "")
            new = set(words).difference(store)
            if new:
                if len(store) + len(new) > KEPT_WORDS:
                    store.clear()
                    new = set(words)
                for x in new:
                    store[x] = tuple([f for f in features_of(x) if f in weights])
            found = Counter([f for x in words if (own := store[x]) for f in own])
            out[k] += sum(weights[f] * math.sqrt(100.0 * n / len(words)) for f, n in sorted(found.items()))
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def fit(
    x: np.ndarray, y: np.ndarray, changes: np.ndarray, columns: dict[str, int], penalty: float = 4.0, ridge: float = 1e-4, rounds: int = 50
) -> ToxicityModel:
    """``fit_gram`` of ``changes``, the rows by which a counterfactual's
    densities differ from its sentence's."""
    return fit_gram(x, y, changes.T @ changes, len(changes), columns, penalty, ridge, rounds)


class Rows:
    """A sparse matrix: the places and values of its cells."""

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, shape: tuple[int, int]):
        self.row, self.col, self.value, self.shape = row, col, value, shape

    @classmethod
    def of(cls, x: np.ndarray) -> Rows:
        row, col = np.nonzero(x)
        return cls(row, col, x[row, col], x.shape)

    def dot(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * v[self.col], self.shape[0])

    def transposed_dot(self, u: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * u[self.row], self.shape[1])

    def squares(self, u: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value**2 * u[self.row], self.shape[1])


def conjugate_gradients(apply, right: np.ndarray, diagonal: np.ndarray, steps: int = 400, close: float = 1e-7) -> np.ndarray:
    """x with ``apply(x)`` = ``right`` for a positive definite ``apply``."""
    x, rest = np.zeros_like(right), right.copy()
    scaled = rest / diagonal
    way, size = scaled.copy(), rest @ scaled
    goal = close * close * max(size, 1e-300)
    for _ in range(steps):
        if size <= goal:
            break
        along = apply(way)
        far = size / (way @ along)
        x += far * way
        rest -= far * along
        scaled = rest / diagonal
        size, before = rest @ scaled, size
        way = scaled + size / before * way
    return x


def fit_gram(
    x: np.ndarray | Rows, y: np.ndarray, gram: np.ndarray, n_changes: int, columns: dict[str, int],
    penalty: float = 4.0, ridge: float = 1e-4, rounds: int = 50, at: np.ndarray | None = None,
) -> ToxicityModel:
    """Newton steps on the log-loss of rows ``x`` (densities) with labels ``y``,
    both classes weighing alike, plus ``penalty`` times the mean squared change
    of the log-odds over ``n_changes`` counterfactuals, which takes only the sum
    ``gram`` of the outer products of their changes (in the columns ``at``, by
    default all).  Steps are solved from products with the sparse rows, so there
    may be as many columns as there are features."""
    if len(y) == 0 or y.min() == y.max():
        # nothing to tell apart: every text scores the smoothed share of toxic rows
        share = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.25
        return ToxicityModel({}, float(np.log(share) - np.log1p(-share)))
    rows = x if isinstance(x, Rows) else Rows.of(x)
    size = rows.shape[1]
    at = np.arange(size) if at is None else at
    weigh = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    tied = 2 * penalty / n_changes * gram if n_changes else np.zeros((len(at), len(at)))
    small = np.append(np.full(size, ridge), 1e-9)

    def logits(v):
        return np.clip(rows.dot(v[:size]) + v[size], -500, 500)

    def fixed(v):
        out = small * v
        out[at] += tied @ v[at]
        return out

    def back(u):
        return np.append(rows.transposed_dot(u), u.sum())

    def loss(v):
        z = logits(v)
        return weigh @ (np.logaddexp(0, z) - y * z) + 0.5 * v @ fixed(v)

    w = np.zeros(size + 1)
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logits(w)))
        gradient = back(weigh * (p - y)) + fixed(w)
        curve = weigh * p * (1 - p) + 1e-9
        diagonal = np.append(rows.squares(curve), curve.sum()) + small
        diagonal[at] += np.diag(tied)
        step = conjugate_gradients(lambda v, c=curve: back(c * (rows.dot(v[:size]) + v[size])) + fixed(v), gradient, diagonal)
        scale = 1.0
        while scale > 1e-4 and loss(w - scale * step) > now:
            scale /= 2
        w = w - scale * step
        before, now = now, loss(w)
        if before - now < 1e-9:
            break
    return ToxicityModel({f: float(w[k]) for f, k in columns.items()}, float(w[size]))


def sample(docs: DataFrame, labels: DataFrame, held_out: Column | None, max_rows: int, id_column: str, text: str) -> DataFrame:
    """At most ``max_rows`` labelled texts, half of them toxic if there are so
    many: those whose ids have the smallest digests.  Rows without an id or a
    label don't take part; a label is 1 if any row of the table says so."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    rows = docs if held_out is None else docs.where(~held_out)
    rows = rows.select(F.col(id_column).alias("label_id"), F.col(text).cast("string").alias("body")).where("label_id is not null")
    drawn = known if held_out is None else known.where(crc_bucket("label_id", 5) != 0)
    # the smallest digests of each class are taken among the narrow labels
    digest = F.xxhash64(F.col("label_id").cast("string"), F.lit("draw"))
    half = max(1, max_rows // 2)
    parts = [drawn.where(F.col("toxic") == c).orderBy(digest, "label_id").limit(half) for c in (0, 1)]
    ids = parts[0].unionByName(parts[1])
    found = rows.join(ids, "label_id")
    # of rows that share an id, one is enough
    return found.groupBy("label_id").agg(F.max_by(F.struct("body", "toxic"), F.xxhash64("body")).alias("r")).select("r.body", F.col("r.toxic").cast("int").alias("toxic"))


def choose_features(drawn: DataFrame, least_chi2: float = 15.0) -> list[str]:
    """All features of ``drawn(body, toxic)`` that mark toxic rows: at least
    ``least_chi2`` by the chi-squared statistic of their presence, in three
    toxic rows or more.  Their number is bounded by the words of the drawn rows."""

    def table(seen):
        names = list({*seen[0], *seen[1]})
        return pd.DataFrame({"f": names, "a": [seen[1][f] for f in names], "b": [seen[0][f] for f in names]})

    def counted(batches):
        seen = [Counter(), Counter()]
        for pdf in batches:
            for body, toxic in zip(pdf["body"], pdf["toxic"]):
                seen[int(toxic > 0)].update({f for w in set(words_of(body or "")) for f in features_of(w)})
                if len(seen[0]) + len(seen[1]) > COUNTED_FEATURES:
                    yield table(seen)
                    seen = [Counter(), Counter()]
        yield table(seen)

    n = drawn.agg(F.count_if(F.col("toxic") > 0).alias("a"), F.count_if(F.col("toxic") <= 0).alias("b")).first()
    if not n.a or not n.b:
        return []
    counts = drawn.mapInPandas(counted, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b, na, nb = F.col("a"), F.col("b"), float(n.a), float(n.b)
    total, seen = na + nb, a + b
    chi2 = total * F.pow(a * (nb - b) - b * (na - a), 2) / (na * nb * seen * (total - seen + 0.5))
    marked = counts.where((a >= 3) & (a * nb > b * na)).withColumn("chi2", chi2).where(F.col("chi2") >= least_chi2)
    return sorted(r.f for r in marked.select("f").collect())


def gram_of(drawn: DataFrame, columns: dict[str, int]) -> tuple[np.ndarray, int]:
    """The sum of the outer products of all counterfactual changes in the bodies
    of ``drawn``, and their number.  Each task sums its own and Spark adds them, so
    the driver gets a cell for each two features at most, however many sentences
    name a group.  Whole numbers are added: any order gives the same sum."""
    size = len(columns)

    def summed(batches):
        gram, n = np.zeros((size, size), dtype="int64"), 0

        def cells():
            i, j = np.nonzero(np.triu(gram))
            out = [(int(a), int(b), Decimal(int(gram[a, b]))) for a, b in zip(i, j)]
            return pd.DataFrame([*out, (-1, -1, Decimal(n))], columns=["i", "j", "v"])

        for pdf in batches:
            for body in pdf["body"]:
                for a, b in counterfactuals(body or ""):
                    change = np.rint((densities(a, columns) - densities(b, columns)) * GRAM_UNIT).astype("int64")
                    at = np.flatnonzero(change)
                    if len(at):
                        gram[np.ix_(at, at)] += np.outer(change[at], change[at])
                        n += 1
                        if n == GRAM_ROWS:
                            yield cells()
                            gram[:], n = 0, 0
        if n:
            yield cells()

    found = drawn.select("body").mapInPandas(summed, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    gram, n = np.zeros((size, size)), 0
    for r in found.collect():
        if r.i < 0:
            n = int(r.v)
        else:
            gram[r.i, r.j] = gram[r.j, r.i] = int(r.v) / GRAM_UNIT**2
    return gram, n


def learn(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column | None = None,
    max_rows: int = 12_000,
    penalty: float = 4.0,
    id_column: str = "doc_id",
    text: str = "text",
) -> ToxicityModel:
    """A model from at most ``max_rows`` labelled rows and all features with
    enough evidence in them.  The driver gets those rows' densities of those
    features that occur, not the texts, and of the counterfactuals one sum over
    the features of names (``gram_of``)."""
    drawn = materialize(sample(docs, labels, held_out, max_rows, id_column, text), "toxicity-sample")
    columns = {f: k for k, f in enumerate(choose_features(drawn))}

    def vectors(batches):
        for pdf in batches:
            own = [sorted(density_of(words_of(body or ""), columns).items()) for body in pdf["body"]]
            yield pd.DataFrame({
                "toxic": pdf["toxic"].astype(int),
                "k": [np.array([k for k, _ in row], dtype="int32").tobytes() for row in own],
                "v": [np.array([v for _, v in row], dtype="float32").tobytes() for row in own],
            })

    pdf = drawn.mapInPandas(vectors, "toxic int, k binary, v binary").toPandas()
    # the same order however the rows came
    pdf = pdf.sort_values(["toxic", "k", "v"], kind="stable")
    row = np.repeat(np.arange(len(pdf)), [len(k) // 4 for k in pdf["k"]])
    col = np.frombuffer(b"".join(pdf["k"]), dtype="int32")
    x = Rows(row, col, np.frombuffer(b"".join(pdf["v"]), dtype="float32").astype(float), (len(pdf), len(columns)))
    names = [f for f in columns if f in IDENTITY_FEATURES]
    gram, n = gram_of(drawn, {f: k for k, f in enumerate(names)})
    at = np.array([columns[f] for f in names], dtype=int)
    return fit_gram(x, (pdf["toxic"].to_numpy() > 0).astype(float), gram, n, columns, penalty, at=at)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus a score from 0 to 1 of every whole text.  A text without
    words (null, empty) has the score of the bias alone, at most 0.49: nothing in
    it is toxic.  A column called ``out`` is replaced."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a weight for each feature of at most max_rows rows

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, store = shipped.value, {}
        for texts in batches:
            values = own.scores(list(texts), store)
            blank = np.array([not (t and _WORD.search(t)) for t in texts], dtype=bool)
            yield pd.Series(np.where(blank, np.minimum(values, 0.49), values))

    return docs.withColumn(out, scored(F.col(text).cast("string")))


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ``held_out`` (crc32 of the id as text is a
    multiple of 5), ``score`` and ``predicted`` (score of at least a half).

    Learns only from labelled rows that aren't held out.  A row without an id
    is held out; rows with equal ids or texts each keep a row; without usable
    labels all texts score alike, below a half; an empty table of documents
    gives no rows.  Further columns are not used."""
    held = F.coalesce(crc_bucket(id_column, 5) == 0, F.lit(True))
    model = learn(docs, labels, held, max_rows, id_column=id_column, text=text)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("body"), held.alias("held_out"))
    scored = score(rows, model, "body")
    return scored.select(F.col("doc_id").alias(id_column), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text scores at least a half, columns as
    given."""
    held = F.coalesce(crc_bucket(id_column, 5) == 0, F.lit(True))
    model = learn(docs, labels, held, max_rows, id_column=id_column, text=text)
    name = "toxicity"
    while name in docs.columns:
        name = "_" + name
    return score(docs, model, text, name).where(F.col(name) < 0.5).drop(name)
