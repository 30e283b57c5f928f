"""Ranked lexical search: a stated set of items against every document.

There is no index of the documents.  The terms of all items are the patterns of
one Aho-Corasick automaton, each guarded by a blank on both sides; a document's
bytes, separators turned to blanks, run through it once, and what the automaton
puts out are occurrences of whole terms.  A pattern's number leads to the items
that hold the term.

1. ``term_counts``: the scan writes for each document its length and the counts
   of the item terms in it.
2. The number of documents, their terms and each term's document frequency are
   aggregates of that table; the weights follow.
3. Scores are whole-number sums over the items of each document's terms, in
   numpy; a task keeps the best rows of each item, and two rankings, the first
   by parts of the documents, leave the best of all.

The automaton goes to the tasks as a broadcast variable, so it has to be small
whatever the number of items: items are dealt to blocks of about ``BLOCK_BYTES``
of text by a hash of their ids, and the documents are scanned once for each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, materialize, text_or_empty

#: Fixed value: what separates terms, every ASCII character but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of item texts whose terms share one automaton.
BLOCK_BYTES = 4 << 20
TOP = 50
#: Scores (documents times items) that a task holds at a time.
CELLS = 1 << 21
#: Parts in which an item's best rows are ranked first.
PARTS = 32

_FOLD = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))
_COUNTED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])
_SCORED = pa.schema([("item_no", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def item_terms(items: DataFrame, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, terms)``: the distinct terms of each item, those of its rows
    together; an item without terms has no row."""
    listed = F.split(ascii_lower(text_or_empty(text)), SEPARATORS)
    single = items.select(F.col(id_column).alias("item_id"), F.explode(listed).alias("term")).where("term <> ''")
    return single.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """The automaton over ``terms``, each between two blanks, which neighbours
    may share; its output is the term's number."""
    found = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        found.add_word(" " + term.encode().decode("latin-1") + " ", k)
    found.make_automaton()
    return found


def count_terms(found: ahocorasick.Automaton, text: bytes) -> tuple[int, Counter]:
    """How many terms a text has, and the counts of those in the automaton, by
    number.  Bytes stand for characters: no UTF-8 byte of a longer character is
    an ASCII one."""
    folded = text.translate(_FOLD)
    return len(folded.split()), Counter(k for _, k in found.iter(" " + folded.decode("latin-1") + " "))


#: The last list of terms that this Python worker has met, and its automaton.
_BUILT: list = [None, None]


def _built(terms: Broadcast) -> ahocorasick.Automaton:
    """The automaton of a broadcast list of terms, made once per Python worker."""
    if _BUILT[0] is not terms.value:
        _BUILT[:] = [terms.value, automaton(terms.value)]
    return _BUILT[1]


def term_counts(docs: DataFrame, terms: list[str], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of each document with a term: its length in
    terms, the numbers of those of ``terms`` in it, and their counts.  Written
    once and read back."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _built(shared)
        for batch in batches:
            ids, lengths, numbers, counts = [], [], [], []
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, tf = count_terms(found, body)
                if n:
                    ids.append(i), lengths.append(n), numbers.append(list(tf.keys())), counts.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((ids, lengths, numbers, counts), _COUNTED)], schema=_COUNTED)

    given = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).cast("binary").alias("body"))
    return materialize(given.mapInArrow(scan, "doc_id long, n long, terms array<int>, tfs array<long>"), "term-counts")


def term_weights(counted: DataFrame, n_docs: int) -> DataFrame:
    """``(term, w)``: floor(1000 ln((2N + 2) / (2df + 1)))."""
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1)
    return df.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("w"))


class Scorer:
    """The items of a block as arrays: for each term number the items that
    hold it, and its weight."""

    def __init__(self, holders: list[np.ndarray], weights: np.ndarray, n_items: int, n_docs: int, total: int, top: int):
        self.sizes = np.array([len(h) for h in holders], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.holders = np.concatenate([*holders, np.empty(0, np.int64)]).astype(np.int64)
        self.weights, self.n_items, self.n_docs, self.total, self.top = weights, n_items, n_docs, total, top

    def scores(self, n: np.ndarray, rows: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """Documents by items, from (row, term, tf) triples and the lengths."""
        m = 100 - 50 + (50 * n * self.n_docs) // self.total
        parts = self.weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[rows]))
        sizes = self.sizes[terms]
        ends = np.cumsum(sizes)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        cell = np.repeat(rows * self.n_items, sizes) + self.holders[np.repeat(self.first[terms], sizes) + inside]
        value = np.repeat(parts, sizes)
        # sums of doubles are exact below 2^53: two halves keep them there
        low, high = value & 0xFFFFFF, value >> 24
        shape = len(n) * self.n_items
        out = np.bincount(cell, low, shape).astype(np.int64) + (np.bincount(cell, high, shape).astype(np.int64) << 24)
        return out.reshape(len(n), self.n_items)

    def pieces(self, rows: np.ndarray, terms: np.ndarray, n_rows: int) -> list[int]:
        """Row numbers at which to cut a batch, so that neither the cells nor
        the single additions of a piece are many."""
        adds = np.bincount(rows, self.sizes[terms], n_rows) + self.n_items
        part = np.cumsum(adds) // CELLS
        return [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n_rows]

    def best(self, kept: tuple, *more: tuple) -> tuple:
        """Of rows (item, id, no id, score) the first ``top`` of each item."""
        item, ids, no_id, score = (np.concatenate(c) for c in zip(kept, *more))
        order = np.lexsort((ids, ~no_id, -score, item))
        item = item[order]
        begin = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.empty(0, np.int64)
        place = np.arange(len(item)) - np.repeat(begin, np.diff(np.append(begin, len(item))))
        order = order[place < self.top]
        return item[place < self.top], ids[order], no_id[order], score[order]

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
        least = np.ones(self.n_items, np.int64)  # what a score has to reach
        for batch in batches:
            ids, no_id = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            n, lists = batch.column(1).to_numpy(), batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            rows = np.repeat(np.arange(len(n)), sizes)
            terms, tfs = lists.flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy()
            cuts = self.pieces(rows, terms, len(n)) if len(n) else []
            for a, b in zip(cuts, cuts[1:]):
                own = slice(*np.searchsorted(rows, [a, b]))
                table = self.scores(n[a:b], rows[own] - a, terms[own], tfs[own])
                if b - a > self.top:
                    least = np.maximum(least, np.partition(table, b - a - self.top, axis=0)[b - a - self.top])
                row, item = np.nonzero(table >= least)
                kept = self.best(kept, (item, ids[a:b][row], no_id[a:b][row], table[row, item]))
                full = np.flatnonzero(np.bincount(kept[0], minlength=self.n_items) >= self.top)
                last = np.searchsorted(kept[0], full, side="right") - 1
                least[full] = np.maximum(least[full], kept[3][last])
        columns = [pa.array(kept[0], pa.int32()), pa.array(kept[1], pa.int64(), mask=kept[2]), pa.array(kept[3], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, schema=_SCORED)


def _search_block(docs: DataFrame, listed: list[tuple], id_type: T.DataType, top: int, id_column: str, text: str) -> DataFrame:
    """The answers for the items ``listed`` as (item_id, terms)."""
    spark = docs.sparkSession
    terms = sorted({t for _, own in listed for t in own})
    number = {t: k for k, t in enumerate(terms)}
    counted = term_counts(docs, terms, id_column, text)
    n_docs, total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    weights = np.zeros(len(terms), np.int64)
    for r in term_weights(counted, n_docs).collect():  # a row for each term of the automaton
        weights[r["term"]] = r["w"]
    holders: list[list[int]] = [[] for _ in terms]
    for k, (_, own) in enumerate(listed):
        for t in own:
            holders[number[t]].append(k)
    scorer = Scorer([np.array(h, np.int64) for h in holders], weights, len(listed), n_docs, total or 0, top)
    shared = spark.sparkContext.broadcast(scorer)
    found = counted.mapInArrow(lambda batches: shared.value.run(batches), "item_no int, doc_id long, score long")
    order = [F.desc("score"), F.asc("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    first = found.withColumn("_p", F.row_number().over(Window.partitionBy("item_no", part).orderBy(*order))).where(F.col("_p") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_no").orderBy(*order))).where(F.col("rank") <= top)
    names = T.StructType([T.StructField("item_no", T.IntegerType()), T.StructField("item_id", id_type)])
    ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(listed)], names)
    return ranked.join(F.broadcast(ids), "item_no").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each item its ``top`` documents
    with a score above 0, ranked by score and ascending id (null first).

    Null texts, of documents as of items, have no terms; such documents count
    nowhere, such items have no answers.  Rows of one item id, also null, are
    one item with the terms of all; documents are rows, so repeated ones are
    ranked each.  Texts of any length are scanned whole.  Without documents or
    items there are no rows.  Further columns of either table are not used."""
    listed = materialize(item_terms(items, item_id, item_text), "item-terms")
    size = listed.agg(F.sum(F.length(F.array_join("terms", " ")) + 16)).first()[0] or 0
    blocks = -(-size // block_bytes)
    id_type = listed.schema["item_id"].dataType
    own = F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks)))
    parts = []
    for b in range(blocks):
        block = [(r["item_id"], r["terms"]) for r in listed.where(own == b).collect()]  # about block_bytes
        if block:
            parts.append(_search_block(docs, block, id_type, top, id_column, text))
    if not parts:
        return _none(docs.sparkSession, id_type)
    return reduce(DataFrame.unionByName, parts)


def _none(spark: SparkSession, id_type: T.DataType) -> DataFrame:
    types = (("item_id", id_type), ("rank", T.IntegerType()), ("doc_id", T.LongType()), ("score", T.LongType()))
    return spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in types]))
