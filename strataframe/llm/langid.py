"""Language identification of mixed texts by word scores and Viterbi.

A word's script, by fixed ranges of code points, narrows its candidates to the
languages that were learned with that script.  Its score in each candidate is
the sum of the log-probabilities of its letter trigrams (with word edges),
hashed into a fixed number of buckets and counted over all training texts.  The
Viterbi algorithm then labels all words of a text so that the scores less a
penalty for each change of language are largest: a foreign word or two stay
with their surroundings, a foreign passage becomes a span of its own.

The path is computed for all texts of a batch at once, one word position at a
time, on arrays of texts by languages.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_bucket

BUCKETS = 1 << 16
PENALTY = 12.0
#: Scripts by ranges of code points; letters outside are "other".
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF), (0xFB1D, 0xFB4F))),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F))),
)
OTHER = len(SCRIPTS)
#: A script belongs to a language that has at least this share of its letters in it.
LEAST_SHARE = 0.01
#: Code points looked at in one go, and words whose paths are kept at once.
SLICE, GROUP_WORDS = 1 << 20, 1 << 21
_FAR = np.float32(-1e6)


@functools.cache
def _letters() -> np.ndarray:
    """By code point: 0 for no letter, else 1 + the number of its script."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = 1 + OTHER
    for k, (_, ranges) in enumerate(SCRIPTS):
        for a, b in ranges:
            part = out[a : b + 1]
            part[part > 0] = 1 + k
    return out


def words_and_grams(text: str, base: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and script of each word (a run of letters; offsets plus
    ``base``), and the hashed trigram around each of its letters."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    # lower-casing may lengthen a letter, so it is done one by one
    kind = _letters()[raw]
    edge = np.concatenate([[0], (kind > 0).view(np.int8), [0]])
    turns = np.diff(edge)
    start, end = np.nonzero(turns == 1)[0], np.nonzero(turns == -1)[0]
    low = np.where(kind > 0, _lower()[raw], 32)
    padded = np.concatenate([[32], low, [32]])
    grams = (padded[:-2] * 0x9E3779B1 + padded[1:-1] * 0x85EBCA77 + padded[2:] * 0xC2B2AE3D) & 0x7FFFFFFFFFFF
    grams = (grams ^ (grams >> 17)) % BUCKETS
    return start + base, end + base, kind[start] - 1, grams[kind > 0]


@functools.cache
def _lower() -> np.ndarray:
    out = np.arange(0x110000, dtype=np.int64)
    for c in range(0x110000):
        x = chr(c).lower()
        if len(x) == 1:
            out[c] = ord(x)
    return out


def _slices(text: str):
    """Parts of a text of about SLICE code points that cut no word, with their
    offsets; a word longer than that is one part."""
    at, letters = 0, _letters()
    while at < len(text):
        stop = min(len(text), at + SLICE)
        while stop < len(text) and letters[ord(text[stop])] and letters[ord(text[stop - 1])]:
            stop += 1
        yield at, text[at:stop]
        at = stop


@dataclass
class LanguageModel:
    """Log-probabilities (buckets x languages) and scripts (x languages)."""

    languages: list[str]
    log: np.ndarray
    allowed: np.ndarray
    penalty: float = PENALTY

    def word_scores(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and scores (words x languages) of a text's words."""
        starts, ends, scores = [], [], []
        for base, part in _slices(text):
            start, end, script, grams = words_and_grams(part, base)
            if len(start):
                first = np.concatenate([[0], np.cumsum(end - start)[:-1]])
                own = np.add.reduceat(self.log[grams], first, axis=0)
                scores.append(np.where(self.allowed[script], own, own.min(axis=1, keepdims=True) + _FAR))
                starts.append(start)
                ends.append(end)
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(self.languages)), np.float32)
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(scores).astype(np.float32)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word.  ``scores`` holds the words of all texts one
    after another, ``lengths`` the words of each text."""
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    stay = np.ones(scores.shape, dtype=bool)
    from_best = np.zeros(len(scores), dtype=np.int16)
    labels = np.zeros(len(scores), dtype=np.int16)
    last = np.zeros(len(lengths), dtype=np.int64)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts longer than t
    value = np.zeros((len(lengths), scores.shape[1]), dtype=np.float64)
    for t in range(longest):
        n = active[t]
        at = begins[:n] + t
        if t:
            v = value[:n]
            best = v.argmax(axis=1)
            change = v[np.arange(n), best] - penalty
            stay[at] = v >= change[:, None]
            from_best[at] = best
            value[:n] = np.maximum(v, change[:, None])
        value[:n] += scores[at]
        done = active[t + 1] if t + 1 < longest else 0
        last[done:n] = value[done:n].argmax(axis=1)
    now = last
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = begins[:n] + t
        labels[at] = now[:n]
        now[:n] = np.where(stay[at, now[:n]], now[:n], from_best[at])
    return labels


def label_texts(texts, model: LanguageModel):
    """For each text: starts, ends and labels of its words, in groups of bounded
    total size (one text may exceed it alone)."""
    group, words = [], 0
    for t in texts:
        group.append(model.word_scores(t or ""))
        words += len(group[-1][0])
        if words > GROUP_WORDS:
            yield from _label_group(group, model)
            group, words = [], 0
    yield from _label_group(group, model)


def _label_group(group, model: LanguageModel):
    if not group:
        return
    lengths = np.array([len(s) for s, _, _ in group], dtype=np.int64)
    labels = viterbi(np.concatenate([x for _, _, x in group]), lengths, model.penalty) if lengths.sum() else np.zeros(0, np.int16)
    at = 0
    for (start, end, _), n in zip(group, lengths):
        yield start, end, labels[at : at + n]
        at += n


def learn(docs: DataFrame, usable: Column | None = None, text: str = "text", lang: str = "lang", penalty: float = PENALTY) -> LanguageModel:
    """A model from all rows with a language (and ``usable``, if given)."""

    def counted(batches):
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for pdf in batches:
            for t, name in zip(pdf["t"], pdf["l"]):
                own = grams.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                kinds = scripts.setdefault(name, np.zeros(OTHER + 1, dtype=np.int64))
                for base, part in _slices(t or ""):
                    start, end, script, found = words_and_grams(part, base)
                    own += np.bincount(found, minlength=BUCKETS)
                    kinds += np.bincount(script, weights=end - start, minlength=OTHER + 1).astype(np.int64)
        for name, own in grams.items():
            both = np.concatenate([own, scripts[name]])
            used = np.nonzero(both)[0]
            # a language whose texts have no letter still counts as learned
            used = used if len(used) else np.array([0])
            yield pd.DataFrame({"l": name, "bucket": used, "n": both[used]})

    rows = docs if usable is None else docs.where(usable)
    rows = rows.select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l")).where("l is not null")
    counts = rows.mapInPandas(counted, "l string, bucket long, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(counts["l"].unique())  # at most languages x (buckets + scripts) rows
    table = np.zeros((BUCKETS + OTHER + 1, len(names)))
    table[counts["bucket"], [names.index(x) for x in counts["l"]]] = counts["n"]
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    log = np.log(grams + 0.5) - np.log(grams.sum(axis=0) + 0.5 * BUCKETS)
    allowed = (scripts > 0) & (scripts >= LEAST_SHARE * scripts.sum(axis=0))
    # a script that no language was learned with leaves all of them
    allowed[~allowed.any(axis=1)] = True
    return LanguageModel(names, log.astype(np.float32), allowed, penalty)


def spans(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "lang_spans") -> DataFrame:
    """``docs`` plus the spans of each text as lang:start:end in code points
    (end exclusive), comma-joined: from the first to the last word of each run
    of words in one language.  Texts without letters have none.  A column called
    ``out`` is replaced."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def listed(texts: pd.Series) -> pd.Series:
        own, rows = shipped.value, []
        if not own.languages:
            return pd.Series([""] * len(texts), dtype=object)
        for start, end, label in label_texts(texts, own):
            turn = np.nonzero(np.diff(label))[0]
            first = np.concatenate([[0], turn + 1]) if len(label) else turn
            final = np.concatenate([turn, [len(label) - 1]]) if len(label) else turn
            rows.append(",".join(f"{own.languages[label[a]]}:{start[a]}:{end[b]}" for a, b in zip(first, final)))
        return pd.Series(rows, dtype=object)

    return docs.withColumn(out, listed(F.col(text).cast("string")))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred``, the language with the most letters on a
    text's path, and ``score``, its share of the letters.  Texts that are null
    or have no letter (or a model of nothing) give ``und`` and 0.  Columns of these
    two names are replaced."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages

    @F.pandas_udf("lang string, share double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        own, rows = shipped.value, []
        if not own.languages:
            return pd.DataFrame({"lang": ["und"] * len(texts), "share": 0.0})
        for start, end, label in label_texts(texts, own):
            if len(label):
                letters = np.bincount(label, weights=end - start, minlength=len(own.languages))
                rows.append((own.languages[int(letters.argmax())], float(letters.max() / letters.sum())))
            else:
                rows.append(("und", 0.0))
        return pd.DataFrame(rows, columns=["lang", "share"])

    found = docs.withColumn("lang_pred", judged(F.col(text).cast("string")))
    return found.withColumn("score", F.col("lang_pred.share")).withColumn("lang_pred", F.col("lang_pred.lang"))


def identify(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: id, ``held_out`` (crc32 of the id as text leaves 2
    when divided by 4), ``lang_pred`` and ``score``.

    Learns only from rows that aren't held out and have a language; a row
    without an id is held out.  Rows with equal ids or texts each give a row, no
    rows give none, further columns are not used."""
    held = F.coalesce(crc_bucket(id_column, 4) == 2, F.lit(True))
    model = learn(docs, ~held, text, lang)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("body"), held.alias("held_out"))
    return predict(rows, model, "body").select(F.col("doc_id").alias(id_column), "held_out", "lang_pred", "score")
