"""Merkle manifest of a table: one tree a group, and a tree over the groups' roots.

1. A row's leaf is the SHA-256 over its columns. Leaves (no texts) are written
   once, dealt by ranges of (group, order, leaf, row) and sorted, so that a
   group of any size spreads over many tasks; a leaf's position in its group
   is its place in the range part plus the counts of the parts before it.
2. Every level joins the nodes with themselves on computed sibling indices.
   With runs of ``fanout`` nodes the indices are slot offsets of 1, 2, 4 and so
   on, modulo the run: after offset d a node holds the digests of the 2d slots
   from its own on, so log2(fanout) equijoins give it its whole run, and no
   join makes more rows than there are nodes. For a binary tree the one offset
   is XOR 1. The rows of slot zero then hold the run in order and emit the
   parents. A level is a written table, and so is what its nodes hold halfway:
   each join reads its input twice, so the plan doubles with every join that
   no written table parts from the one before.
3. The proof of a node is its siblings left and right of it, then those of its
   parent, up to the root: from the top down each level is joined with the
   paths of the level above, which are written.

Digests are kept as 32 bytes and hashed as hexadecimal text. The groups' roots
are the leaves of the last tree, ordered by group (null first, bytewise).

Defined results: a null column counts as ``-``, apart from the empty text; a
null group is a group of its own; null order keys come first; rows with equal
keys are ordered by their leaves, and equal rows have leaves of their own. A
group of one row has its leaf as root. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devpulse.plans.staging import stage_table

DIGEST = 32
#: ``monotonically_increasing_id`` keeps the row's place in its partition in so many bits.
PLACE_BITS = 33
_PATH = "array<struct<left:binary,right:binary>>"
#: Doublings of the offset in one plan.
DOUBLINGS = 2


def digest(value: Column) -> Column:
    """SHA-256 of a text as bytes."""
    return F.unhex(F.sha2(value.cast("binary"), 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 over columns, each ``-`` if null, else its UTF-8 length, ``:`` and the value."""
    texts = [c.cast("string") for c in columns]
    return digest(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts)))


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [a[c].eqNullSafe(b[c]) for c in columns])


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows, written, with ``_part`` and ``_place``, and what leads from these to positions:
    ``group, _part, _shift, n`` (position: ``_place + _shift``; ``n`` rows in the group)."""
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    placed = stage_table(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("_at", F.monotonically_increasing_id()), name)
    placed = (placed.withColumn("_part", F.shiftright("_at", PLACE_BITS))
              .withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).drop("_at"))
    parts = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(*group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                          F.sum("_n").over(whole).alias("n"))
    return placed, stage_table(shifts, f"{name}-parts")


def with_runs(nodes: DataFrame, fanout: int, also: Sequence[str] = (), name: str = "merkle") -> DataFrame:
    """``tree, idx, n, slot, run, w`` and ``also``: ``w`` is the digests of the node's run from its own slot on, cyclic.

    ``nodes`` has ``tree, idx, n, h``: ``n`` nodes in the tree at this level. Every ``DOUBLINGS`` joins the rows are written.
    """
    slot = F.col("idx") % fanout
    now = nodes.select("tree", "idx", "n", slot.alias("slot"),
                       F.least(F.lit(fanout).cast("long"), F.col("n") - F.col("idx") + slot).alias("run"),
                       F.col("h").alias("w"), *also)
    offset = joins = 1
    while offset < fanout:
        if joins > DOUBLINGS:
            now, joins = stage_table(now, f"{name}-runs-{offset}"), 1
        # What the node at slot + offset holds, addressed to this one.
        sibling = F.col("idx") - F.col("slot") + (F.col("slot") - offset + F.col("run")) % F.col("run")
        missing = F.least(F.lit(offset).cast("long"), F.col("run") - offset)
        sent = now.where(F.col("run") > offset).select(
            "tree", sibling.alias("idx"), F.substring("w", F.lit(1), (missing * DIGEST).cast("int")).alias("more"))
        now = now.join(sent, ["tree", "idx"], "left").select(
            "tree", "idx", "n", "slot", "run",
            F.when(F.col("more").isNull(), F.col("w")).otherwise(F.concat("w", "more")).alias("w"), *also)
        offset, joins = 2 * offset, joins + 1
    return now


def climb(leaves: DataFrame, fanout: int, name: str, also: Sequence[str] = ()) -> list[DataFrame]:
    """The levels of all trees, leaves first, each written (columns of ``with_runs``)."""
    n = leaves.agg(F.max("n")).first()[0] or 0
    levels = [stage_table(with_runs(leaves, fanout, also, name), f"{name}-level-0")]
    while n > 1:
        n = -(-n // fanout)
        parents = levels[-1].where("n > 1 AND slot = 0").select(
            "tree", F.floor(F.col("idx") / fanout).cast("long").alias("idx"),
            F.ceil(F.col("n") / fanout).cast("long").alias("n"), digest(hexed(F.col("w"))).alias("h"))
        levels.append(stage_table(with_runs(parents, fanout, name=name), f"{name}-level-{len(levels)}"))
    return levels


def roots(levels: Sequence[DataFrame]) -> DataFrame:
    """``tree, h`` of every tree."""
    return reduce(DataFrame.union, [level.where("n = 1").select("tree", F.col("w").alias("h")) for level in levels])


def paths(levels: Sequence[DataFrame], tops: DataFrame, fanout: int, name: str, also: Sequence[str] = ()) -> DataFrame:
    """``tree, idx, h, path``, the other columns of ``tops`` and ``also``, for the lowest level.

    ``tops`` (written) has ``tree, path`` (what comes above a tree's root) and columns to hand down. The paths of
    the other levels are written.
    """
    down = [c for c in tops.columns if c not in ("tree", "path")]
    tail = F.col("run") - F.col("slot")
    right = F.substring("w", F.lit(1 + DIGEST), ((tail - 1) * DIGEST).cast("int"))
    left = F.substring("w", (tail * DIGEST + 1).cast("int"), (F.col("slot") * DIGEST).cast("int"))
    above = None
    for i, level in reversed(list(enumerate(levels))):
        extra = also if i == 0 else ()
        head = ("tree", "idx", F.substring("w", F.lit(1), F.lit(DIGEST)).alias("h"))
        here = level.where("n = 1").join(tops, "tree").select(*head, "path", *down, *extra)
        if above is not None:
            upper = above.select("tree", F.col("idx").alias("_up"), F.col("path").alias("_rest"), *down)
            own = F.array(F.struct(left.alias("left"), right.alias("right"))).cast(_PATH)
            inner = (level.where("n > 1").withColumn("_up", F.floor(F.col("idx") / fanout).cast("long"))
                     .join(upper, ["tree", "_up"])
                     .select(*head, F.concat(own, "_rest").alias("path"), *down, *extra))
            here = here.union(inner)
        above = stage_table(here, f"{name}-paths-{i}") if i else here
    return above


def proofs(df: DataFrame, columns: Sequence[str], group: str, order: str, fanout: int,
           also: Sequence[str] = ()) -> DataFrame:
    """``order, leaf, subroot, root`` (hexadecimal), ``path`` and the columns ``also``, a row for each row.

    ``path`` lists the digests left and right of the node at every level from the leaf to the root.
    """
    spark = df.sparkSession
    leaves = stage_table(
        df.select(F.col(group).alias("_group"), F.col(order).alias("_key"),
                  leaf_digest([F.col(c) for c in columns]).alias("h"), *(F.col(c).alias(f"_also_{c}") for c in also))
        .withColumn("_row", F.monotonically_increasing_id()), "merkle-leaves")
    carried = ["_key", *(f"_also_{c}" for c in also)]
    placed, parts = numbered(leaves, ["_group"], ["_key", "h", "_row"], "merkle-placed")
    groups, group_parts = numbered(parts.select("_group").distinct(), [], ["_group"], "merkle-groups")
    groups = stage_table(groups.join(group_parts, "_part").select(
        "_group", (F.col("_place") + F.col("_shift")).alias("tree"), F.col("n").alias("_trees")), "merkle-trees")
    parts = stage_table(parts.join(groups, _same(parts, groups, ["_group"])).select(
        parts["_group"], "_part", "_shift", "n", "tree"), "merkle-shifts")
    nodes = placed.join(parts, _same(placed, parts, ["_group", "_part"])).select(
        "tree", (F.col("_place") + F.col("_shift")).alias("idx"), "n", "h", *carried)
    levels = climb(nodes, fanout, "merkle", carried)
    subroots = stage_table(roots(levels).join(groups, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("_trees").alias("n"), "h"),
        "merkle-subroots")
    upper = climb(subroots, fanout, "merkle-upper")
    top = stage_table(roots(upper).select("tree", F.array().cast(_PATH).alias("path"), F.col("h").alias("root")), "merkle-root")
    tops = stage_table(paths(upper, top, fanout, "merkle-upper").select(
        F.col("idx").alias("tree"), "path", F.col("h").alias("subroot"), "root"), "merkle-tops")
    found = paths(levels, tops, fanout, "merkle", carried)
    return found.select(F.col("_key").alias(order), hexed(F.col("h")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
                        hexed(F.col("root")).alias("root"), "path", *(F.col(f"_also_{c}").alias(c) for c in also))


def siblings_digest(path: Column) -> Column:
    """SHA-256 (hexadecimal) over all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: hexed(F.concat(p["left"], p["right"]))), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root (hexadecimal) that a leaf (hexadecimal) and its path give."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(hexed(p["left"]), h, hexed(p["right"])), 256))
