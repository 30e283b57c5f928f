"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  If
two fingerprints differ in at most two bits, some segment ``i`` is equal in
both while the next one ``i + 1`` differs in at most one bit:

* (1, 1, 0) errors: the equal segment is followed by one with one error;
* (2, 0, 0) or fewer: of the two equal segments that stand in a ring of
  three, one is followed by the other.

The next segment is read as a word of the perfect binary Golay code (23, 12),
padded with zeros.  Every word is within three bits of exactly one codeword.
Its keys are the index of that codeword and, for a word at distance three,
those of the five codewords at distance four.  Two words one bit apart then
always share an index: if they decode to different codewords, the first word's
codeword lies at distance four from the second word, which itself must be at
distance three from its own.  A key is (i, segment i, codeword index), about
16 keys of 33 bits each per fingerprint.

Buckets of a key hold distinct fingerprints only.  In a small bucket all pairs
are compared.  A larger one is linked without pairs: each member is attached to
the 64 fingerprints one bit away from it and to itself.  Two fingerprints that
meet in such a midpoint differ by two bits at most, and any two that differ by
two bits or fewer meet, so the links are exactly those of the pairs, with 65
rows a member however large the bucket is.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialize, row_digest
from .components import connected_components

SEED = 42
#: Fixed value: the Golay code's generator polynomial, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Shingles hashed at a time, so that a very long text needs bounded memory.
BLOCK = 1 << 16
#: Members up to which a bucket's pairs are compared one by one.
PAIR_LIMIT = 16


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """The SimHash of a text's UTF-8 bytes as a signed 64-bit integer.

    Words are runs without ASCII white space, A-Z lower-cased; a text with
    fewer words than ``shingle`` is one shingle, without words zero."""
    words = raw.lower().split()
    total = max(len(words) - shingle + 1, 1)
    if not words:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, total, BLOCK):
        part = words[at : at + BLOCK + shingle - 1]
        grams = [b" ".join(x) for x in zip(*(part[k:] for k in range(shingle)))] or [b" ".join(part)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64, count=len(grams))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > total, bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` plus the fingerprint of ``text`` as a long (null: zero)."""

    @F.pandas_udf(T.LongType())
    def hashed(raw: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x or b"", shingle) for x in raw], dtype="int64")

    return docs.withColumn(out, hashed(F.col(text).cast("string").cast("binary")))


@functools.cache
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error patterns of weight up to three (first column)
    and, for those of weight three, the five of weight four (else -1)."""
    one = np.array([_remainder(1 << k) for k in range(23)], dtype=np.int64)
    first = np.full(2048, -1, dtype=np.int64)
    more = [[] for _ in range(2048)]
    weight = np.zeros(2048, dtype=np.int64)
    first[0] = 0
    bits = range(23)
    for a in bits:
        first[one[a]], weight[one[a]] = 1 << a, 1
        for b in range(a):
            s = one[a] ^ one[b]
            first[s], weight[s] = 1 << a | 1 << b, 2
            for c in range(b):
                s3 = s ^ one[c]
                first[s3], weight[s3] = 1 << a | 1 << b | 1 << c, 3
    for a in bits:
        for b in range(a):
            for c in range(b):
                for d in range(c):
                    s = one[a] ^ one[b] ^ one[c] ^ one[d]
                    if weight[s] == 3:
                        more[s].append(1 << a | 1 << b | 1 << c | 1 << d)
    table = np.full((2048, 6), -1, dtype=np.int64)
    table[:, 0] = first
    for s, patterns in enumerate(more):
        table[s, 1 : 1 + len(patterns)] = patterns
    return one, table


def _remainder(word: int) -> int:
    for k in range(22, 10, -1):
        if word >> k & 1:
            word ^= GENERATOR << (k - 11)
    return word


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """For each 23-bit word, up to six 12-bit codeword indices (-1: none)."""
    one, table = _golay()
    syndrome = np.zeros(len(words), dtype=np.int64)
    for k in range(23):
        syndrome ^= np.where(words >> k & 1, one[k], 0)
    errors = table[syndrome]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def golay_keys(prints: np.ndarray) -> np.ndarray:
    """Keys of signed 64-bit fingerprints: 18 columns, -1 where unused."""
    raw = prints.astype(np.int64).view(np.uint64)
    parts = [(raw >> np.uint64(at) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    out = []
    for i in range(3):
        index = codeword_indices(parts[(i + 1) % 3])
        key = (i << 34) | (parts[i] << 12)
        out.append(np.where(index < 0, -1, key[:, None] | index))
    return np.concatenate(out, axis=1)


def _explode_keys(distinct: DataFrame) -> DataFrame:
    def keyed(batches):
        for pdf in batches:
            prints = pdf["fp"].to_numpy(dtype=np.int64)
            keys = golay_keys(prints)
            row, column = np.nonzero(keys >= 0)
            yield pd.DataFrame({"fp": prints[row], "key": keys[row, column]})

    return distinct.select("fp").mapInPandas(keyed, "fp long, key long")


def links(distinct: DataFrame, max_bits: int = 2, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """``distinct(fp)``: distinct fingerprints.  Returns ``(a, b)`` whose
    connected components are those of all pairs at ``max_bits`` or fewer
    differing bits (two at most, which is what the keys guarantee)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the keys find pairs of at most two differing bits")
    keys = materialize(_explode_keys(distinct), "golay-keys")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(keys.join(sizes, "key"), "golay-buckets")
    small = shared.where(F.col("n") <= pair_limit)
    left, right = small.select("key", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = left.join(right, "key").where((F.col("a") < F.col("b")) & near).select("a", "b")
    large = shared.where(F.col("n") > pair_limit).select("fp").distinct()
    return pairs.union(_midpoint_links(large, max_bits)).distinct()


def _midpoint_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links of a crowded neighbourhood without making its pairs.

    Meeting in a midpoint is exact for two bits; for fewer, the members of a
    midpoint (65 at most) are compared with each other."""
    flips = F.expr("transform(sequence(0, 63), k -> fp ^ shiftleft(1L, k))")
    spread = prints.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("mid"))
    met = spread.groupBy("mid").agg(F.array_sort(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    if max_bits == 2:
        return met.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 65)).alias("b"))
    return (
        met.select("fps", F.explode("fps").alias("a"))
        .select("a", F.explode("fps").alias("b"))
        .where(f"a < b and bit_count(a ^ b) <= {int(max_bits)}")
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of ``max_bits``
    or fewer differing bits.

    A null or empty text has fingerprint zero and links like any other.  Rows
    with equal ids or texts each keep their row.  A null id never becomes a
    component's id unless the component has no other (then it is null).  An
    empty table gives no rows; further columns of ``docs`` are not used."""
    prints = materialize(
        fingerprints(docs.select(F.col(id_column).alias("id"), F.col(text).alias("body")), shingle, "body", "fp").select("id", "fp"),
        "fingerprints",
    )
    distinct = prints.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = connected_components(links(distinct, max_bits))
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = materialize(labelled.join(smallest, "root").select("fp", "component_id"), "simhash-classes")
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the
    smallest id, a null id last; rows with equal ids are told apart by a digest
    of all their columns, and of rows equal in every column one stays."""
    (key,) = fresh(docs, "row_key")
    order = F.struct(F.col(id_column).isNull().alias("nameless"), F.col(id_column).alias("id"), row_digest(docs).alias("digest"))
    keyed = docs.withColumn(key, order)
    found = near_duplicates(keyed, shingle, max_bits, key, text)
    first = found.select(F.col("component_id.digest").alias("first_digest")).distinct()
    kept = keyed.withColumn(key, F.col(f"{key}.digest")).join(first, F.col(key) == F.col("first_digest"), "left_semi")
    return kept.dropDuplicates([key]).drop(key)
