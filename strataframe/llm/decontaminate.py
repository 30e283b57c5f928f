"""Benchmark decontamination with a distributed positional inverted index.

``positional_index`` stores one posting (term, text key, position) for every
occurrence of a test term in the training texts, as a written table.  Phrases
are found from it as search engines do: each phrase starts from the postings of
its rarest terms, every list is moved back by the term's offset in the phrase,
and the moved lists are intersected; what survives the two rarest lists is
intersected with the lists of all other terms.  ``proximity_matches`` answers
unordered queries from the same index.

Only DataFrame functions are used.  Texts are indexed under a digest of their
content, so that copies of a text meet in one set of postings and answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, ascii_lower, materialize, small_side, text_or_empty

#: Fixed value: what separates words, every ASCII character but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: Parts into which the slots of a word are dealt if frequencies can't be broadcast.
SLOT_PARTS = 16


def words_of(text: Column) -> Column:
    """The lower-cased words of a text, in order."""
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def text_key(column: str = "text") -> Column:
    return F.unhex(F.md5(text_or_empty(column).cast("binary")))


def windows_of(items: DataFrame, size: int = WINDOW, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, window_id, terms)``: all runs of ``size`` words of each
    item, or all its words if it has fewer (none: no window)."""
    listed = items.select(F.col(id_column).alias("item_id"), words_of(text_or_empty(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    runs = listed.select("item_id", "w", F.explode(starts).alias("k")).select(
        "item_id", F.expr(f"slice(w, k, {int(size)})").alias("terms")
    )
    return runs.select("item_id", F.md5(F.concat_ws(" ", "terms").cast("binary")).alias("window_id"), "terms").distinct()


def positional_index(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """``(term, text_key, pos)`` for each occurrence of one of ``terms(term)``
    in ``docs``, written once and read back."""
    # key and words in a projection of their own, below the generator, or the
    # digest would be computed again for every word
    listed = docs.select(text_key(text).alias("text_key"), words_of(text_or_empty(text)).alias("words"))
    tokens = listed.select("text_key", F.posexplode("words").alias("pos", "term"))
    return materialize(tokens.join(small_side(terms, "term"), "term").select("term", "text_key", "pos"), "postings")


def _ranked_slots(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """``phrases(window_id, terms)`` as one row per term and offset, ``rank`` 1
    for the term with the fewest postings.  A phrase with a term that has no
    posting can't occur and goes."""
    frequency = materialize(index.groupBy("term").agg(F.count(F.lit(1)).alias("freq")), "term-frequency")
    slots = phrases.select("window_id", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "term"))
    order = Window.partitionBy("window_id").orderBy("freq", "offset")
    # a common word is a term of very many phrases: their slots stay where they
    # are, or beyond a broadcast are dealt by word and phrase
    if (frequency.agg(F.sum(F.length("term") + 32)).first()[0] or 0) <= BROADCAST_BYTES:
        met = slots.join(F.broadcast(frequency), "term")
    else:
        parts = F.explode(F.sequence(F.lit(0), F.lit(SLOT_PARTS - 1)))
        part = F.pmod(F.xxhash64("window_id"), F.lit(SLOT_PARTS)).cast("int")
        met = slots.withColumn("_part", part).join(frequency.withColumn("_part", parts), ["term", "_part"]).drop("_part")
    ranked = met.withColumn("rank", F.row_number().over(order))
    whole = Window.partitionBy("window_id")
    return ranked.withColumn("found", F.count(F.lit(1)).over(whole)).where("found = n").drop("found")


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(text_key, start, n, window_id)``: where ``phrases(window_id, terms)``
    occur in the indexed texts, one row per place."""
    slots = materialize(_ranked_slots(phrases, index), "slots")
    rare = slots.where("rank <= 2")
    lists = index.join(small_side(rare.select("window_id", "offset", "n", "term"), "term"), "term")
    moved = lists.select("text_key", (F.col("pos") - F.col("offset")).alias("start"), "window_id", "n", "offset").where("start >= 0").distinct()
    both = moved.groupBy("text_key", "start", "window_id", "n").agg(F.count(F.lit(1)).alias("lists")).where("lists = least(n, 2)")
    survivors = materialize(both.drop("lists"), "survivors")
    # the other lists, only of texts that still have a candidate
    texts = survivors.select("text_key").distinct()
    rest = index.join(small_side(texts, "text_key"), "text_key", "left_semi").distinct()
    expected = survivors.join(small_side(slots.where("rank > 2").select("window_id", "offset", "term"), "term"), "window_id").select(
        "text_key", (F.col("start") + F.col("offset")).alias("pos"), "term", "start", "window_id", "n"
    )
    met = expected.join(rest, ["text_key", "pos", "term"]).groupBy("text_key", "start", "window_id", "n").agg(F.count(F.lit(1)).alias("lists"))
    short = survivors.where("n <= 2")
    return met.where("lists = n - 2").drop("lists").unionByName(short).select("text_key", "start", "n", "window_id")


def proximity_matches(index: DataFrame, phrases: DataFrame, width: int) -> DataFrame:
    """``(text_key, anchor, window_id)``: places of a phrase's rarest term with
    all its other terms, in any order, at most ``width`` words away.

    A term that a phrase holds more than once is looked for once.  Postings
    meet by blocks of ``width`` positions, so a pair of lists is never joined
    over a whole text."""
    if width < 1:
        raise ValueError("width must be at least 1")
    sets = phrases.select("window_id", F.array_distinct("terms").alias("terms"))
    slots = materialize(_ranked_slots(sets, index), "near-slots")
    anchors = (
        index.join(small_side(slots.where("rank = 1").select("window_id", "n", "term"), "term"), "term")
        .distinct()
        .select("text_key", F.col("pos").alias("anchor"), "window_id", "n")
    )
    block = F.floor(F.col("anchor") / width)
    wanted = anchors.withColumn("block", F.explode(F.array(block - 1, block, block + 1))).join(
        small_side(slots.where("rank > 1").select("window_id", "term"), "term"), "window_id"
    )
    blocks = index.distinct().withColumn("block", F.floor(F.col("pos") / width))
    near = wanted.join(blocks, ["text_key", "block", "term"]).where(F.abs(F.col("pos") - F.col("anchor")) <= width)
    met = near.groupBy("text_key", "anchor", "window_id", "n").agg(F.count_distinct("term").alias("terms")).where("terms = n - 1")
    alone = anchors.where("n = 1")
    return met.select("text_key", "anchor", "window_id").unionByName(alone.select("text_key", "anchor", "window_id"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    percent: int = 5,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_hit`` (words inside
    an occurrence of a window), ``n_items`` and ``items_sha256`` (of the items
    with such windows), ``contaminated`` (some word hit, and at least
    ``percent`` of all words), and ``text_key``.

    A null text has no words; a null item id has windows that hit but is not
    counted or listed as an item; repeated items count once.  An empty table of
    documents gives no rows, one of items marks nothing.  Further columns of
    either table are not used."""
    windows = materialize(windows_of(items, size, item_id, item_text), "windows")
    phrases = windows.select("window_id", "terms").distinct()
    index = positional_index(docs, phrases.select(F.explode("terms").alias("term")).distinct(), text)
    found = materialize(phrase_matches(index, phrases), "matches")
    covered = """aggregate(array_sort(spans), struct(0L as hit, 0L as reach), (a, s) -> struct(
        a.hit + greatest(0L, s.till - greatest(s.start, a.reach)) as hit, greatest(a.reach, s.till) as reach), a -> a.hit)"""
    hits = (
        found.select("text_key", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("n")).cast("long").alias("till"))
        .groupBy("text_key")
        .agg(F.collect_set(F.struct("start", "till")).alias("spans"))
        .select("text_key", F.expr(covered).alias("n_hit"))
    )
    listed = (
        found.select("text_key", "window_id")
        .distinct()
        .join(small_side(windows.select("window_id", "item_id"), "window_id"), "window_id")
        .where("item_id is not null")
        .select("text_key", F.col("item_id").cast("string").alias("item"))
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    answers = materialize(hits.join(listed, "text_key", "left").select("text_key", "n_hit", "items"), "answers")
    # copies of one text may be a third of all rows: they stay where they are if
    # the answers can be broadcast, else the join's hot keys are split at run time
    if (answers.agg(F.sum(F.coalesce(F.size("items"), F.lit(0)) * 24 + 64)).first()[0] or 0) <= BROADCAST_BYTES:
        answers = F.broadcast(answers)
    every = docs.select(
        F.col(id_column).alias(id_column), text_key(text).alias("text_key"), F.size(words_of(text_or_empty(text))).cast("long").alias("n_words")
    )
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return every.join(answers, "text_key", "left").select(
        id_column,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items_of).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (100 * n_hit >= percent * F.col("n_words"))).alias("contaminated"),
        "text_key",
    )


def clean_documents(docs: DataFrame, items: DataFrame, size: int = WINDOW, percent: int = 5, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text is contaminated, columns as given."""
    judged = contamination(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text")), items, size, percent)
    spoiled = materialize(judged.where("contaminated").select("text_key").distinct(), "contaminated")
    key = text_key(text)
    return docs.join(small_side(spoiled.withColumnRenamed("text_key", "spoiled_key"), "spoiled_key"), key == F.col("spoiled_key"), "left_anti")
