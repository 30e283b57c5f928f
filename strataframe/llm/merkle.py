"""A Merkle manifest of a table: leaf digests, roots, and a proof for each row.

Rows are leaves of one tree per group (of documents: per language), the group
roots are leaves of a tree above.  A tree is built from *concatenated-level
strings*: the nodes of a level of an aligned block of leaves are one string of
hexadecimal digests of fixed width.  The level above is the digests of the
string's consecutive substrings of ``fan`` digests; the siblings of a node are
the substrings before and after it inside its run, and a run that the level's
end cuts short is simply a shorter substring.  A block is reduced to its top in
one row, the tops of a group's blocks are the leaves of the next round, and so
on until each group is one block; so no task holds more than a block, whatever
the size of a group.  All of it is SQL expressions.

Positions within a group come from a range partitioning by group and id that is
written once: a row's place in its partition, plus the rows of its group in the
partitions before, which is a table of one row per partition and group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, materialize

#: Characters of a digest.
WIDTH = 64
FAN = 2
#: Levels that one block holds: ``FAN ** DEPTH`` leaves.
DEPTH = 8
SEGMENTS = "array<struct<before:string,after:string>>"


def digest(text: Column) -> Column:
    """H: the SHA-256 of a string's UTF-8 bytes as lower-case hexadecimal."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its UTF-8 length, a
    colon and itself, so that no two rows give the same input."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The leaf of a row with these values."""
    return digest(F.concat(*[field(v) for v in values]))


def fold(node: Column, segments: Column) -> Column:
    """The root that a leaf and its sibling segments, lowest first, lead to."""
    return F.aggregate(segments, node, lambda at, s: digest(F.concat(s["before"], at, s["after"])))


def proof_text(segments: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(segments, lambda s: F.concat(s["before"], s["after"])), "")


def _parents(level: Column, fan: int) -> Column:
    """The level string above a level string."""
    run = WIDTH * fan
    last = F.floor((F.length(level) - 1) / run).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda k: digest(F.substring(level, k * run + 1, F.lit(run)))), "")


def _levels(lowest: Column, more: Column, fan: int, depth: int) -> Column:
    """All level strings of a block, lowest first.  A block that is its whole
    group ends at its single top; one of ``more`` goes up by ``depth`` levels,
    also where a short last block already has a single node."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(depth)),
        F.array(lowest),
        lambda done, _: F.when(
            more | (F.length(F.element_at(done, -1)) > WIDTH), F.concat(done, F.array(_parents(F.element_at(done, -1), fan)))
        ).otherwise(done),
    )


def _segments(levels: Column, place: Column, fan: int) -> Column:
    """The siblings of the leaf at ``place`` of a block, on each level below
    the top: what lies before and after it in its run."""

    def flanks(level: Column, j: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(fan), j)).cast("int")
        inside = at % fan
        return F.struct(
            F.substring(level, (at - inside) * WIDTH + 1, inside * WIDTH).alias("before"),
            F.substring(level, (at + 1) * WIDTH + 1, (fan - 1 - inside) * WIDTH).alias("after"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), flanks)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the place (from 0) of a row in its group by
    ``order``, and ``n``, the rows of the group.  Rows equal in ``group`` and
    ``order`` are numbered in any order."""
    sorted_rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = materialize(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_at", 33)
    runs = placed.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("_group")
    before = F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_group", "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("n"))
    runs = materialize(runs, "merkle-runs")
    met = placed.join(_small(runs, F.length("_group") + 64), (F.col(group) == F.col("_group")) & (part == F.col("_part")))
    return met.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_group", "_part", "_first", "_before")


def _small(df: DataFrame, size: Column) -> DataFrame:
    """``df`` to be broadcast if the sum of ``size`` over its rows allows it."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def climb(nodes: DataFrame, group: str, payload: Sequence[str] = (), fan: int = FAN, depth: int = DEPTH) -> list[DataFrame]:
    """The written rounds of the trees over ``nodes(group, pos, n, node)``, one
    tree per group: rows of a block with its members (and their ``payload``),
    its level strings and its top.  In the last round a group is one block."""
    width, rounds = fan**depth, []
    while True:
        members = F.sort_array(F.collect_list(F.struct("pos", "node", *payload)))
        block = F.floor(F.col("pos") / width).alias("block")
        blocks = nodes.groupBy(F.col(group), block).agg(members.alias("members"), F.max("n").alias("n"))
        lowest = F.array_join(F.transform("members", lambda m: m["node"]), "")
        blocks = blocks.withColumn("levels", _levels(lowest, F.col("n") > width, fan, depth))
        rounds.append(materialize(blocks.withColumn("top", F.element_at("levels", -1)), "merkle-round"))
        if (rounds[-1].agg(F.max("n")).first()[0] or 0) <= width:
            return rounds
        nodes = rounds[-1].select(group, F.col("block").alias("pos"), F.ceil(F.col("n") / width).alias("n"), F.col("top").alias("node"))
        payload = ()


def descend(rounds: list[DataFrame], above: DataFrame, group: str, payload: Sequence[str] = (), fan: int = FAN) -> DataFrame:
    """From the tops down, each leaf with all its sibling segments.

    ``above(group, segments, ...)`` has a row for each group: the segments
    over its root, and columns that all its leaves get.  Returns the group, the
    ``payload``, ``pos``, ``node``, ``segments`` and those columns."""
    given = [c for c in above.columns if c not in (group, "segments")]
    above, on = above.withColumnRenamed("segments", "_over"), [group]
    for blocks in reversed(rounds):
        own = [*payload] if blocks is rounds[0] else []
        above = _small(above, F.length(group) + F.size("_over") * (WIDTH * (fan - 1) + 32) + (WIDTH + 16) * len(given) + 32)
        met = blocks.join(above, on)

        members = F.transform("members", _proven(own, fan))
        rows = met.select(group, *given, F.explode(members).alias("m")).select(group, *given, "m.*")
        if blocks is rounds[0]:
            return rows
        above = materialize(rows.select(group, F.col("pos").alias("block"), F.col("segments").alias("_over"), *given), "merkle-above")
        on = [group, "block"]


def _proven(payload: Sequence[str], fan: int) -> Callable[[Column, Column], Column]:
    """What makes a block's member at a place a leaf with all its segments."""

    def member(m: Column, place: Column) -> Column:
        segments = F.concat(_segments(F.col("levels"), place, fan), F.col("_over"))
        return F.struct(*[m[c].alias(c) for c in ("pos", "node", *payload)], segments.alias("segments"))

    return member


def manifest(leaves: DataFrame, order: Sequence[str], payload: Sequence[str] = (), fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """The tree over ``leaves(grp, node, ...)``: one tree per non-null string
    ``grp``, leaves by ``order``, then by digest; over it a tree of the groups'
    roots by ``grp`` bytewise.

    Returns ``grp``, the ``payload``, ``pos``, ``node``, ``segments`` (siblings
    up to the root), ``subroot`` and ``root`` for each leaf; no leaves: no rows."""
    if fan < 2 or depth < 1:
        raise ValueError("fan must be at least 2 and depth at least 1")
    rounds = climb(numbered(leaves, "grp", [*order, "node"]), "grp", payload, fan, depth)
    subroots = rounds[-1].select(F.lit("").alias("all"), "grp", F.col("top").alias("node"))
    upper = climb(numbered(subroots, "all", ["grp"]), "all", ["grp"], fan, depth)
    top = upper[-1].select("all", F.array().cast(SEGMENTS).alias("segments"), F.col("top").alias("root"))
    roots = descend(upper, top, "all", ["grp"], fan).select("grp", "segments", F.col("node").alias("subroot"), "root")
    return descend(rounds, materialize(roots, "merkle-roots"), "grp", payload, fan)


def document_manifest(docs: DataFrame, tampered: Column | None = None, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs(doc_id, source, lang, n_chars, text)``: doc_id,
    its ``leaf``, the ``subroot`` of its language, the ``root``, the
    ``proof_sha256`` of its siblings, ``folded_root`` (from its leaf, or where
    ``tampered`` is true from the leaf of the row with 1 added to ``n_chars``)
    and ``verified`` (that this is the root).

    Null values enter a leaf as ``-``; a null language is a group, before all
    others, and a null id comes first in its group.  Rows of one id are ordered
    by leaf; equal rows are leaves side by side.  An empty table has no rows.
    Further columns, whatever they are called, are not used."""
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [c if i != 3 else c + 1 for i, c in enumerate(row)]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("grp"),
        F.col("doc_id"),
        leaf(*row).alias("node"),
        (F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf(*changed))).alias("other"),
    )
    leaves = materialize(leaves, "merkle-leaves")
    proven = manifest(leaves, ["doc_id"], ["doc_id", "other"], fan, depth)
    return proven.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        digest(proof_text(F.col("segments"))).alias("proof_sha256"),
        fold(F.coalesce("other", "node"), F.col("segments")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
