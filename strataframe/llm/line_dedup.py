"""Lines that many documents share, dropped by probing a compact index.

The index holds a slot for each distinct line that at least two documents
have.  It is sharded by the line's hash; in a shard a minimal perfect hash leads
each line to a slot of its own in two plain arrays, one of fingerprints and one
of document counts.  The perfect hash is a cascade of bit arrays: a key that
falls on a bit alone stays there, the others go on to the next, smaller array;
a key's slot is the number of set bits before its own.  A line that isn't in the
index ends on no set bit, or on another's slot, where the fingerprint differs.

Documents aren't joined with lines.  They are dealt evenly to blocks by id and
text; a block asks for each of its distinct lines once, so a line that stands
in a third of all documents is asked for by each block, not by each document.
Questions go to the shard's arrays, the lines to be dropped come back to the
block, and the block's texts are cut there.  Every step is by block or by
shard: none holds more than one of these, and nothing grows with the corpus but
their number.

A line is known by two independent 64-bit XXH64 hashes of its key: the first
chooses the shard, both choose the slot, the second is the fingerprint.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, text_or_empty

#: Fixed value: what is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
#: Documents of a block and bytes of their texts, whichever makes more blocks,
#: and questions that a shard answers, about.
BLOCK_ROWS, BLOCK_BYTES = 2048, 16 << 20
SHARD_ROWS = 1 << 18
#: Bits of a cascade's array for each key that comes to it.
SPREAD = 2
#: Counts are held in 32 bits and stay at the greatest.
MOST = (1 << 32) - 1

_SEED = 42
# the seed that hashing the number 1 before the key leaves
_SECOND_SEED = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), seed=_SEED)
_SHARD = "shard int, sizes array<long>, bits binary, prints binary, counts binary"
_STRIPPED = "doc_id {}, n_lines long, n_dropped long, text string"


def line_keys(text: str, min_chars: int) -> Column:
    """The distinct keys of a text's lines that count."""
    keys = F.transform(F.split(text_or_empty(text), "\n"), lambda line: ascii_lower(F.btrim(line, F.lit(BLANKS))))
    return F.array_distinct(F.filter(keys, lambda key: F.length(key) >= min_chars))


def key_hashes(key: bytes) -> tuple[int, int]:
    """The two hashes of a key, as Spark's ``xxhash64`` gives them, unsigned."""
    return xxhash.xxh64_intdigest(key, seed=_SEED), xxhash.xxh64_intdigest(key, seed=_SECOND_SEED)


# -- the perfect hash ---------------------------------------------------------


def _place(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where keys fall in the bit array of a level: both hashes mixed with the
    level's number (steps of the SplitMix64 generator)."""
    x = first ^ (second * np.uint64(2 * level + 1)) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """A cascade of bit arrays, end to end, and their sizes."""

    sizes: list[int]
    bits: np.ndarray

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray) -> PerfectHash:
        """For distinct pairs of hashes."""
        sizes, arrays = [], []
        while len(first):
            size = SPREAD * len(first) + 1
            at = _place(first, second, len(sizes), size)
            hits = np.bincount(at, minlength=size)
            sizes.append(size)
            arrays.append(hits == 1)
            left = hits[at] > 1
            first, second = first[left], second[left]
        return cls(sizes, np.concatenate(arrays) if arrays else np.empty(0, bool))

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slots of pairs of hashes; -1 for what ends on no set bit."""
        before = np.cumsum(self.bits) - self.bits
        out, open_, start = np.full(len(first), -1, np.int64), np.arange(len(first)), 0
        for level, size in enumerate(self.sizes):
            at = start + _place(first[open_], second[open_], level, size)
            here = self.bits[at]
            out[open_[here]] = before[at[here]]
            open_, start = open_[~here], start + size
        return out


@dataclass
class Shard:
    """The perfect hash of a shard's lines, and their arrays by slot."""

    hash: PerfectHash
    prints: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> Shard:
        perfect = PerfectHash.of(first, second)
        order = np.argsort(perfect.slots(first, second))
        return cls(perfect, second[order], np.minimum(counts, MOST).astype(np.uint32)[order])

    def row(self, number: int) -> dict:
        """The shard as a row of the index table."""
        packed = np.packbits(self.hash.bits).tobytes()
        return {"shard": number, "sizes": self.hash.sizes, "bits": packed, "prints": self.prints.tobytes(), "counts": self.counts.tobytes()}

    @classmethod
    def read(cls, row: dict) -> Shard:
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
        return cls(PerfectHash(row["sizes"], bits), np.frombuffer(row["prints"], np.uint64), np.frombuffer(row["counts"], np.uint32))

    def documents(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """How many documents have these lines; 0 for lines the index lacks."""
        slots = self.hash.slots(first, second)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == second[known]
        out = np.zeros(len(first), np.int64)
        out[known] = self.counts[slots[known]]
        return out


def _unsigned(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().astype(np.int64).view(np.uint64)


# -- the steps on Spark -------------------------------------------------------


def line_questions(docs: DataFrame, blocks: int, min_chars: int = 1, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(block, h1, h2, n)``: the distinct lines of each block, and how many
    of the block's documents have them.  Written once and read back."""
    listed = docs.select(_block(blocks, id_column, text).alias("block"), F.explode(line_keys(text, min_chars)).alias("key"))
    hashed = listed.select("block", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    return materialize(hashed.groupBy("block", "h1", "h2").agg(F.count(F.lit(1)).alias("n")), "line-questions")


def _block(blocks: int, id_column: str, text: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_column), F.col(text)), F.lit(blocks)).cast("int")


def _shard(shards: int) -> Column:
    return F.pmod("h1", F.lit(shards)).cast("int").alias("shard")


def line_index(questions: DataFrame, shards: int, least: int = 2) -> DataFrame:
    """The index of the lines that at least ``least`` documents have: a row for
    each shard that has any.  Written once and read back."""

    def build(table: pa.Table) -> pa.Table:
        made = Shard.of(_unsigned(table, "h1"), _unsigned(table, "h2"), table.column("n").to_numpy())
        types = [("shard", pa.int32()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary())]
        return pa.Table.from_pylist([made.row(table.column("shard")[0].as_py())], pa.schema(types))

    counted = questions.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return materialize(counted.select(_shard(shards), "h1", "h2", "n").groupBy("shard").applyInArrow(build, _SHARD), "line-index")


def probe(questions: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """``(block, h1, h2)``: the lines of each block that at least ``min_docs``
    documents have, by the arrays of ``index``."""
    answer = pa.schema([("block", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])

    def ask(asked: pa.Table, arrays: pa.Table) -> pa.Table:
        if not arrays.num_rows or not asked.num_rows:
            return answer.empty_table()
        shard = Shard.read(arrays.to_pylist()[0])
        hit = shard.documents(_unsigned(asked, "h1"), _unsigned(asked, "h2")) >= min_docs
        return asked.filter(pa.array(hit)).select(["block", "h1", "h2"]).cast(answer)

    asked = questions.select(_shard(shards), "block", "h1", "h2").groupBy("shard")
    return asked.cogroup(index.groupBy("shard")).applyInArrow(ask, "block int, h1 long, h2 long")


def strip_text(text: bytes, dropped: dict[int, set[int]], min_chars: int) -> tuple[int, int, bytes]:
    """A text without its dropped lines: lines before, lines dropped, text."""
    lines, kept = text.split(b"\n"), []
    for line in lines:
        key = line.strip(BLANKS.encode()).lower()  # of bytes: A-Z only
        if key and xxhash.xxh64_intdigest(key, seed=_SEED) in dropped and (min_chars < 2 or len(key.decode()) >= min_chars):
            first, second = key_hashes(key)
            if second in dropped[first]:
                continue
        kept.append(line)
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def drop_shared_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    id_column: str = "doc_id",
    text: str = "text",
    block_rows: int = BLOCK_ROWS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_lines``, ``n_dropped`` and
    the ``text`` that stays, its lines joined by a newline.

    A line's key is the line without blanks at its ends, A-Z lower-cased.  Keys
    of at least ``min_chars`` code points (one at least: empty lines stay) in at
    least ``min_docs`` documents lose all their lines; a document counts once
    for a key, and rows are documents, also equal ones or ones of one id.

    A null or empty text is one empty line; null ids are kept; texts may be of
    any length.  An empty table gives no rows.  Further columns are not used."""
    if min_docs < 1 or min_chars < 1:
        raise ValueError("min_docs and min_chars must be at least 1")
    size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(text_or_empty(text)))).first()
    blocks = 1 + max(size[0] // block_rows, (size[1] or 0) // BLOCK_BYTES)
    questions = line_questions(docs, blocks, min_chars, id_column, text)
    shards = 1 + questions.count() // shard_rows
    index = line_index(questions, shards, min(2, min_docs))
    answers = probe(questions, index, shards, min_docs)
    id_type = docs.schema[id_column].dataType

    def strip(given: pa.Table, found: pa.Table) -> pa.Table:
        dropped: dict[int, set[int]] = {}
        if found.num_rows:
            for first, second in zip(_unsigned(found, "h1").tolist(), _unsigned(found, "h2").tolist()):
                dropped.setdefault(first, set()).add(second)
        cut = [strip_text(body, dropped, min_chars) for body in given.column("body").to_pylist()]
        columns = [pa.array([c[0] for c in cut], pa.int64()), pa.array([c[1] for c in cut], pa.int64())]
        kept = pa.array([c[2] for c in cut], pa.binary()).cast(pa.string())
        return pa.table([given.column("doc_id"), *columns, kept], ["doc_id", "n_lines", "n_dropped", "text"])

    placed = docs.select(_block(blocks, id_column, text).alias("block"), F.col(id_column).alias("doc_id"), text_or_empty(text).cast("binary").alias("body"))
    return placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(strip, _STRIPPED.format(id_type.simpleString()))
