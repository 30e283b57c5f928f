"""Quality filtering by weak supervision.

Instead of dropping a text as soon as one rule fails, every rule votes good or
bad or abstains; expectation-maximisation over the vote patterns of the whole
corpus estimates how often each rule is right, without labels, and a text is
kept if the posterior probability that it is good reaches a threshold.  Two hard
rules (too few words, mostly repeated windows) still reject at once.

The patterns are counted on the executors; the driver sees at most 3^rules
counts.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .label_model import LabelModel

#: The contract's white space and symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
RULES = (
    "length", "repeats", "symbols", "symbol_words", "duplicate_lines", "letters", "capitals", "common_word", "short_words", "sentences",
    "exclamations",
)
_SYMBOL_BYTES = frozenset(SYMBOLS.encode())
_END_BYTES = frozenset(b".!?")
#: ASCII bytes that are no letters.
_NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
_SPACE_BYTES = SPACES.encode()
_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three words that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    total, reach = 0, 0
    for k, w in enumerate(windows):
        if often[w] > 1:
            total += k + 3 - max(k, reach)
            reach = k + 3
    return total


def measures(text: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The base measures of a text and the rules' votes on it."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    duplicates = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    base = (n, chars, symbols, duplicates, repeats)
    if not n:
        return base, (-1,) + (0,) * (len(RULES) - 1)

    def vote(value, good, bad):
        """+1 up to ``good``, -1 from ``bad`` on, between them no vote."""
        return 1 if value <= good else -1 if value >= bad else 0

    letters = len(raw.translate(None, _NO_LETTERS)) / len(raw.translate(None, _SPACE_BYTES))
    shouted = sum(map(bytes.isupper, words)) / n
    ends = Counter([w[-1] for w in words])
    marked = sum(ends[b] for b in _SYMBOL_BYTES) / n
    sentences = sum(ends[b] for b in _END_BYTES)
    sizes = Counter(map(len, words))
    short = sum(sizes[k] for k in (1, 2, 3)) / n
    most = max(Counter(words).values())
    few = n < 20  # a share of a few words says little
    votes = (
        -1 if n < MIN_WORDS else 1 if n >= 100 else 0,
        vote(repeats / n, 0.05, 0.2),
        vote(symbols / n, 0.02, 0.2),
        vote(marked, 0.05, 0.25),
        vote(duplicates / len(lines), 0.1, 0.3),
        vote(1 - letters, 0.1, 0.2),
        vote(shouted, 0.15, 0.4),
        0 if few else vote(most / n, 0.15, 0.3),
        0 if few else vote(-short, -0.2, -0.1),
        0 if few else 1 if 3 <= n / (sentences + 1) <= 50 else -1,
        vote(text.count("!") / n, 0.05, 0.3),
    )
    return base, votes


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def measured(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, base measures, ``base_failed`` and ``votes``
    (one of ``-0+`` for each rule)."""

    @F.pandas_udf(", ".join(f"{n} long" for n in _NAMES) + ", base_failed boolean, votes string")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            base, votes = measures(t or "")
            rows.append((*base, failed(base[0], base[4]), "".join("-0+"[v + 1] for v in votes)))
        return pd.DataFrame(rows, columns=[*_NAMES, "base_failed", "votes"])

    found = docs.select(F.col(id_column).alias("doc_id"), of(F.col(text).cast("string")).alias("m"))
    return found.select(F.col("doc_id").alias("doc_id"), "m.*")


def fit(patterns: dict[str, int]) -> tuple[LabelModel, dict[str, float]]:
    """The rules' reliabilities and each pattern's probability of being good,
    from the number of texts of each vote pattern that passed the hard rules:
    what those reject would otherwise be the bad class, whole and alone."""
    keys = sorted(patterns)
    votes = np.array([["-0+".index(v) - 1 for v in k] for k in keys], dtype=np.int64).reshape(-1, len(RULES))
    model = LabelModel(len(RULES), prior=0.7, smoothing=5.0).fit(votes, np.array([patterns[k] for k in keys], dtype=float))
    return model, dict(zip(keys, map(float, model.posterior(votes))))


def judge(docs: DataFrame, threshold: float = 0.5, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept`` and
    ``quality``, the posterior probability.

    A null text counts as empty: no words, base_failed.  Rows with equal ids or
    texts each give a row and a vote, no rows give none, further columns are not
    used."""
    spark = docs.sparkSession
    rows = materialize(measured(docs, id_column, text), "quality-votes")
    passed = F.count_if(~F.col("base_failed")).alias("passed")
    patterns = {r.votes: r.passed for r in rows.groupBy("votes").agg(passed).collect()}  # at most 3^rules
    chances = fit(patterns)[1]
    table = spark.createDataFrame(sorted(chances.items()), "votes string, quality double")
    judged = rows.join(F.broadcast(table), "votes")
    return judged.select(
        F.col("doc_id").alias(id_column), *_NAMES, "base_failed", (~F.col("base_failed") & (F.col("quality") >= threshold)).alias("kept"), "quality"
    )
