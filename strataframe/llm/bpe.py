"""BPE encoding and decoding by forced-boundary splitting.

A merge can only join bytes that stand next to each other in some vocabulary
token.  A pair of bytes that occurs inside no token is therefore a certain
token boundary, and what lies on its two sides can be encoded apart and the
ids concatenated.  ``ForcedBoundaries`` reads the pairs from the vocabulary
and cuts at those that the tokenizer's own splitting also respects, so that
nothing else of it has to be redone here:

* pairs with a space, tab, line feed or carriage return (no token holds one,
  and the pre-tokenizer drops them);
* pairs of a letter, an ASCII digit and an ASCII sign, by a table of which
  signs and digits follow or precede letters, digits and signs inside no token
  (``CutTable``).  The pre-tokenizer ends its piece at each of these places
  whatever stands on either side: letters end before anything else, a digit is a
  piece of its own, and signs end before a letter or a digit.  One pair is not
  such a place, an apostrophe before a letter, with which a piece may begin.

Letters are those of ASCII and Latin-1, whose case and composition no ASCII
neighbour changes; runs with any other character are cut before their first sign
only.  A special string holds such pairs inside: a part of a run with its
beginning is kept whole.  Fragments repeat a lot, so each task keeps the results
of short ones.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
#: Signs that may be cut off, where the vocabulary allows it.
SIGNS = ".,;:!?|()[]{}#$%&*+-/<=>@^_~\"\\`"
#: Letters whose case and composition no following ASCII sign can change.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Fragments longer than this are encoded each time instead of being kept.
KEPT_CHARS = 64
#: Fragments kept by a Python worker; beyond it the store starts anew.
KEPT_FRAGMENTS = 300_000


def _byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable
    Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class CutTable:
    """Which neighbouring characters are a forced boundary: the byte pair is
    inside no token, for every letter or digit of the class beside it."""

    def __init__(self, pairs: set[tuple[int, int]], special: list[str]):
        letters = [ord(c) for c in (*"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",)]
        digits = [ord(c) for c in "0123456789"]
        signs = [c for c in range(0x21, 0x7F) if c not in letters and c not in digits]

        def free(left, right) -> bool:
            return not any((x, y) in pairs for x in left for y in right)

        own = [*signs, *digits]
        self.after_letter = [c for c in own if free(letters, [c])]
        self.before_letter = [c for c in own if chr(c) != "'" and free([c], letters)]
        # Latin-1 letters are the bytes 0xC3 and one of 0x80 to 0xBF
        self.after_latin = [c for c in own if free(range(0x80, 0xC0), [c])]
        self.before_latin = [c for c in own if chr(c) != "'" and free([c], [0xC3])]
        self.after_digit = [c for c in own if free(digits, [c])]
        self.before_digit = [c for c in signs if free([c], digits)]
        letter, latin, digit = "[A-Za-z]", f"[{LETTERS.removeprefix('A-Za-z')}]", "[0-9]"
        places = [
            (letter, self._set(self.after_letter)), (self._set(self.before_letter), letter), (latin, self._set(self.after_latin)),
            (self._set(self.before_latin), latin), (digit, self._set(self.after_digit)), (self._set(self.before_digit), digit),
        ]
        cuts = [f"(?<={x})(?={y})" for x, y in places if x and y]
        self.cut = re.compile("|".join(cuts)) if cuts else None
        self.plain = re.compile(f"[!-~{LETTERS}]+")
        self.openings = tuple({x[:2] for x in special})

    @staticmethod
    def _set(codes: list[int]) -> str:
        return f"[{re.escape(''.join(map(chr, codes)))}]" if codes else ""

    def split(self, run: str) -> list[str]:
        """A run without white space in its parts."""
        if self.cut is None or len(run) < 2 or run.isalpha() or not self.plain.fullmatch(run) or any(x in run for x in self.openings):
            return [run]
        return self.cut.split(run)


class ForcedBoundaries:
    """Cuts, encodes and decodes with one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.pairs = self._pairs_inside(spec["model"]["vocab"], suffix)
        self.cut_signs = "".join(c for c in SIGNS if self._never_after_letter(c))
        spaces = [c for c in " \t\n\r" if not any(ord(c) in p for p in self.pairs)]
        if len(spaces) < 4:
            raise ValueError("the vocabulary holds white space inside tokens")
        run = "[^ \t\n\r]+"
        self.pattern = re.compile(f"[{LETTERS}]*[A-Za-z](?=[{re.escape(self.cut_signs)}])|{run}" if self.cut_signs else run)
        self.table = CutTable(self.pairs, self.special)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.numbers = [str(i) for i in range(size)]
        self.tokens = [self.tokenizer.id_to_token(i) for i in range(size)]
        self.known: dict[str, tuple[int, str, str]] = {}

    def _pairs_inside(self, vocabulary: dict[str, int], suffix: str) -> set[tuple[int, int]]:
        """All pairs of neighbouring bytes inside the ordinary tokens."""
        letters, special, pairs = _byte_letters(), set(self.special), set()
        for token in vocabulary:
            if token not in special:
                raw = [letters[c] for c in (token.removesuffix(suffix) if suffix else token)]
                pairs.update(zip(raw, raw[1:]))
        return pairs

    def _never_after_letter(self, sign: str) -> bool:
        last = [*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]
        return not any((b, ord(sign)) in self.pairs for b in last)

    def fragments(self, text: str) -> list[str]:
        """The parts of ``text`` between forced boundaries, without the white
        space that no token holds."""
        split = self.table.split
        return [x for run in self.pattern.findall(text) for x in ((run,) if run.isalpha() else split(run))]

    def _learn(self, fragments: list[str]) -> dict[str, tuple[int, str, str]]:
        """Token count, ids and tokens (both joined by spaces) of fragments."""
        out, numbers, tokens = {}, self.numbers, self.tokens
        for fragment, code in zip(fragments, self.tokenizer.encode_batch_fast(fragments, add_special_tokens=False)):
            ids = code.ids
            out[fragment] = (len(ids), " ".join([numbers[i] for i in ids]), " ".join([tokens[i] for i in ids]))
        return out

    def encode(self, text: str) -> tuple[int, str, str]:
        """Token count, decimal ids joined by one space, decoded text.

        The vocabulary has no decoder of its own, for which the library joins
        tokens by one space; that is also how fragments are joined."""
        parts = self.fragments(text)
        known = self.known
        new = [p for p in set(parts) if p not in known]
        once = {}
        if new:
            short = [p for p in new if len(p) <= KEPT_CHARS]
            once = self._learn([p for p in new if len(p) > KEPT_CHARS])
            if len(known) + len(short) > KEPT_FRAGMENTS:
                # start anew, with what this text needs
                once.update((p, known[p]) for p in set(parts) if p in known)
                known.clear()
            found = self._learn(short)
            if len(short) <= KEPT_FRAGMENTS:
                known.update(found)
            once.update(found)
        if once:
            codes = [once.get(p) or known[p] for p in parts]
        else:
            codes = [known[p] for p in parts]
        codes = [c for c in codes if c[0]]
        return sum(c[0] for c in codes), " ".join([c[1] for c in codes]), " ".join([c[2] for c in codes])


@functools.cache
def _loaded(path: str) -> ForcedBoundaries:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    found = ForcedBoundaries(path)
    if found.tokenizer.decoder is not None:
        raise ValueError("only vocabularies without a decoder are joined by spaces")
    return found


def _path(vocabulary: str) -> str:
    """A file's place on the machine that asks: a path or a public name."""
    return vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)


def encode_texts(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` plus ``bpe``: a struct of ``n_tokens`` (long), ``ids`` (array of
    ints) and ``decoded`` (string).  Null and empty texts have no tokens.  A
    column named bpe is replaced."""

    @F.pandas_udf("n_tokens long, ids string, decoded string")
    def coded(texts: pd.Series) -> pd.DataFrame:
        own = _loaded(_path(vocabulary))
        return pd.DataFrame([own.encode(t or "") for t in texts], columns=["n_tokens", "ids", "decoded"])

    out = docs.withColumn("bpe", coded(F.col(text).cast("string")))
    ids = F.when(F.col("bpe.ids") == "", F.array().cast("array<int>")).otherwise(F.split("bpe.ids", " ").cast("array<int>"))
    return out.withColumn("bpe", F.struct(F.col("bpe.n_tokens").alias("n_tokens"), ids.alias("ids"), F.col("bpe.decoded").alias("decoded")))


def decode_ids(coded: DataFrame, vocabulary: str = VOCABULARY, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` plus the text of the array of token ids in ``ids`` (null: null)."""

    @F.pandas_udf(T.StringType())
    def texts(lists: pd.Series) -> pd.Series:
        own = _loaded(_path(vocabulary)).tokenizer
        return pd.Series([None if x is None else own.decode([int(i) for i in x], skip_special_tokens=False) for x in lists], dtype=object)

    return coded.withColumn(out, texts(F.col(ids)))


def token_digests(docs: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, and the SHA-256 of the decimal
    ids joined by one space and of the decoded text in UTF-8.

    A null text counts as empty, which has no tokens and the digests of the
    empty string.  Rows with equal ids or texts each give a row, no rows give
    none, further columns are not used."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digested(texts: pd.Series) -> pd.DataFrame:
        own, rows = _loaded(_path(vocabulary)), []
        for t in texts:
            n, ids, decoded = own.encode(t or "")
            rows.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    pair = docs.select(F.col(id_column).alias("doc_id"), digested(F.col(text).cast("string")).alias("d"))
    return pair.select(F.col("doc_id").alias(id_column), "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")
