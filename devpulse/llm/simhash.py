"""SimHash near-duplicates through vantage-point trees.

1. Every text gets a 64-bit fingerprint (one map over the rows); rows of the
   same fingerprint are collapsed by a partial aggregate, so copies never meet
   in a pair.
2. Two vantage-point trees, one for each half of the fingerprint's bits, over a
   sample of the distinct fingerprints (a fixed share of them, at most
   ``SAMPLE_PER_SHARD`` for each of at most ``MAX_SHARDS`` shards) are sent to
   the tasks. A node holds a vantage point and a radius; distances are taken on
   the tree's half. Of two fingerprints within ``bits`` of each other one half
   differs by ``bits // 2`` at most, so there their distances to the vantage
   point differ by no more than that (triangle inequality), and it is enough
   that those on one side within ``bits // 2`` of the boundary visit the other
   side too: every linked pair meets in a shard of one of the trees. Over whole
   fingerprints the boundary is ``bits`` wide, and the copies that visit a
   second side grow several times as fast with the number of shards.
3. A shard continues the same split in memory, then one over whole fingerprints
   where the half separates no further, down to small leaves, where pairs are
   compared exactly. It reports no pairs but each linked fingerprint's local
   component, so a dense group costs one row a member.
4. A fingerprint seen in several shards ties their local components together;
   the graph of these components is joined by minimum labels with pointer
   jumping, each round written to the shared folder.

Defined results: a null or empty text, and one of white space only, has
fingerprint zero and is linked like any other; a text shorter than a shingle
is one shingle. Rows with a null key get a component like others; the
component id is the smallest non-null key (null if there is none). Repeated
rows give repeated results. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.llm.batches import slices
from devpulse.plans.staging import stage_table

SEED = 42
#: Distinct fingerprints a shard is meant to hold, and shards (of one tree) and sample rows at most.
SHARD = 4096
MAX_SHARDS = 1 << 14
SAMPLE_PER_SHARD = 64
#: Fingerprints compared pair by pair in a leaf.
LEAF = 512
#: A split must leave at most this share of the pairs that could meet.
PAIRS_LEFT = 0.9
WHOLE = np.uint64(2**64 - 1)
HALVES = np.array([2**32 - 1, 2**64 - 2**32], np.uint64)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, words: int) -> int:
    """64-bit SimHash of the word shingles of a text (A-Z lower-cased, split at ASCII white space)."""
    listed = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not listed:
        return 0
    shingles = ([b" ".join(listed)] if len(listed) < words
                else map(b" ".join, zip(*(listed[i:] for i in range(words)))))
    n = max(1, len(listed) - words + 1)
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, n)
    octets = hashes.astype("<u8").view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp``: the fingerprint as a signed long."""
    return _fingerprints(df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")),
                         words).withColumnRenamed("key", key)


def _fingerprints(df: DataFrame, words: int) -> DataFrame:
    """``key, fp`` and the columns after ``key, text``."""

    def run(batches):
        for batch in slices(batches, 1):
            fps = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                                             ["key", "fp", *batch.schema.names[2:]])

    schema = T.StructType([df.schema["key"], T.StructField("fp", T.LongType()), *df.schema.fields[2:]])
    return df.mapInArrow(run, schema)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def choose_split(points: np.ndarray, bits: int, rng: np.random.Generator,
                 mask: np.uint64 = WHOLE) -> tuple[int, int, bool] | None:
    """Vantage point, radius and whether inner points visit the outer side; None if no split separates.

    Points within the radius are inside; distances count the bits of ``mask``.
    Of a few vantage points and all radii, the split that leaves the fewest
    pairs is taken, copies at the boundary included.
    """
    best, n = None, len(points)
    for vantage in rng.choice(points, min(8, n), replace=False):
        cum = np.concatenate([np.zeros(bits + 1), np.cumsum(np.bincount(
            distance(points & mask, vantage & mask), minlength=65)), np.full(bits + 1, n)])
        at = np.arange(bits + 1, bits + 66)  # radius 0 to 64
        inside, outside = cum[at], n - cum[at]
        inner, outer = cum[at] - cum[at - bits], cum[at + bits] - cum[at]
        left = np.where(inner <= outer, inside ** 2 + (outside + inner) ** 2, (inside + outer) ** 2 + outside ** 2)
        radius = int(left.argmin())
        if left[radius] <= PAIRS_LEFT * n * n and (best is None or left[radius] < best[0]):
            best = left[radius], (int(vantage), radius, bool(inner[radius] <= outer[radius]))
    return best and best[1]


def sides(points: np.ndarray, split: tuple[int, int, bool], bits: int,
          mask: np.uint64 = WHOLE) -> tuple[np.ndarray, np.ndarray]:
    """Which points go inside and which outside; those at the boundary go both ways."""
    vantage, radius, inner_visits = split
    d = distance(points & mask, np.uint64(vantage) & mask).astype(np.int64)
    if inner_visits:
        return d <= radius, d > radius - bits
    return d <= radius + bits, d > radius


def build_tree(sample: np.ndarray, shards: int, bits: int, mask: np.uint64 = WHOLE) -> list:
    """Nested ``[split, inside, outside]``; a leaf is its shard number.

    A part of the sample is split until it is no more than one of ``shards``
    equal parts, so that a dense region is split as far as its points allow.
    """
    rng = np.random.default_rng(SEED)
    numbered = iter(range(1 << 30))
    enough = max(8, len(sample) // shards)

    def grow(points: np.ndarray):
        split = choose_split(points, bits, rng, mask) if len(points) > enough else None
        if split is None:
            return next(numbered)
        inside, outside = sides(points, split, bits, mask)
        return [split, grow(points[inside]), grow(points[outside])]

    return grow(np.unique(sample))


def route(points: np.ndarray, tree, bits: int, mask: np.uint64 = WHOLE) -> Iterator[tuple[int, np.ndarray]]:
    """``(shard, points)`` for every shard a batch of fingerprints reaches."""
    stack = [(tree, points)]
    while stack:
        node, some = stack.pop()
        if isinstance(node, int):
            yield node, some
            continue
        inside, outside = sides(some, node[0], bits, mask)
        stack += [(n, some[m]) for n, m in ((node[1], inside), (node[2], outside)) if m.any()]


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of a[i] and b[i]; ``parent`` holds each element's smallest member before and after."""
    while True:
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(parent, parent[parent]):
            parent[:] = parent[parent]


def local_components(points: np.ndarray, bits: int, halves: Iterable[int] = (0, 1)) -> np.ndarray:
    """For distinct, sorted fingerprints the position of each one's smallest component member.

    Finds the links that differ by ``bits // 2`` at most in one of ``halves``: with both, all.
    """
    parent = np.arange(len(points))
    rng = np.random.default_rng(SEED)
    stack = [(parent.copy(), bits // 2, HALVES[h]) for h in halves]
    while stack:
        at, slack, mask = stack.pop()
        if len(at) > LEAF:
            split = choose_split(points[at], slack, rng, mask)
            if split is None and mask != WHOLE:
                slack, mask = bits, WHOLE
                split = choose_split(points[at], slack, rng, mask)
            if split:
                inside, outside = sides(points[at], split, slack, mask)
                stack += [(at[inside], slack, mask), (at[outside], slack, mask)]
                continue
        for i in range(0, len(at), LEAF):  # more than one block only where no split separates
            for j in range(i, len(at), LEAF):
                a, b = at[i:i + LEAF], at[j:j + LEAF]
                near = distance(points[a][:, None], points[b][None, :]) <= bits
                near &= parent[a][:, None] != parent[b][None, :]
                if near.any():
                    x, y = np.nonzero(near)
                    _union(parent, a[x], b[y])
    return parent


def _shard_links(fps: DataFrame, bits: int) -> DataFrame:
    """``fp, root``: for each shard, the smallest member of a linked fingerprint's local component."""
    n = fps.count()
    shards = 1
    while shards < min(MAX_SHARDS, n / SHARD):
        shards *= 2
    trees = [0, 0]
    if shards > 1:
        every = max(1, n // (shards * SAMPLE_PER_SHARD))
        sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).limit(2 * shards * SAMPLE_PER_SHARD)
        points = sample.toArrow()["fp"].to_numpy().view(np.uint64)
        trees = [build_tree(points, shards, bits // 2, mask) for mask in HALVES]

    def scatter(batches):
        for batch in batches:
            points = batch.column(0).to_numpy().view(np.uint64)
            for half, tree in enumerate(trees):
                for shard, some in route(points, tree, bits // 2, HALVES[half]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), 2 * shard + half, np.int32)), pa.array(some.view(np.int64))],
                        ["shard", "fp"])

    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        points = np.unique(table["fp"].to_numpy().view(np.uint64))
        parent = local_components(points, bits, [key[0].as_py() % 2])
        linked = np.bincount(parent, minlength=len(points))[parent] > 1
        return pa.table({"fp": points[linked].view(np.int64), "root": points[parent[linked]].view(np.int64)})

    return (fps.select("fp").mapInArrow(scatter, "shard int, fp long")
            .groupBy("shard").applyInArrow(search, "fp long, root long"))


def connected(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable over edges ``a, b``, by minimum labels and pointer jumping."""
    both = stage_table(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct(), "component-edges")
    labels = stage_table(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")),
                         "component-labels")
    while True:
        heard = (both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node"))
                 .agg(F.min("label").alias("heard")))
        lower = labels.join(heard, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = stage_table(lower.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "component-labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("node", "label")


def _components(docs: DataFrame, bits: int, key: str) -> DataFrame:
    """``fp, group, component_id`` for every fingerprint; ``group`` names the component."""
    fps = stage_table(docs.groupBy("fp").agg(F.min(key).alias("first")), "distinct-fingerprints")
    links = stage_table(_shard_links(fps, bits), "shard-links")
    lowest = stage_table(links.groupBy("fp").agg(F.min("root").alias("low")), "lowest-roots")
    edges = links.join(lowest, "fp").select(F.col("low").alias("a"), F.col("root").alias("b")).where("a <> b").distinct()
    labels = connected(edges)
    grouped = (fps.join(lowest, "fp", "left").join(labels.withColumnRenamed("node", "low"), "low", "left")
               .select("fp", "first", F.coalesce("label", "low", "fp").alias("group")))
    smallest = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    return grouped.join(smallest, "group").select("fp", "group", "component_id")


def near_duplicates(df: DataFrame, words: int, bits: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint, component_id`` for every row."""
    docs = stage_table(fingerprints(df, words, key, text), "fingerprints")
    return docs.join(_components(docs, bits, key), "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, words: int, bits: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: of the smallest key (nulls last), then of the smallest fingerprint and row hash.

    Of rows with equal keys and texts one stays, whatever their other columns hold. Rows are known by 128 bits of
    hash over key and text, so that the choice of equal rows and the join share one shuffle.
    """
    row = (F.col(key).isNull(), F.col(key), F.col(text).isNull(), F.col(text))
    hashes = {"_h1": F.xxhash64(F.lit(1), *row), "_h2": F.xxhash64(F.lit(2), *row)}
    docs = stage_table(_fingerprints(df.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"), *(c.alias(n) for n, c in hashes.items())),
        words), "fingerprints")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "fp", "_h1", "_h2")
    chosen = (docs.join(_components(docs, bits, "key"), "fp").groupBy("group").agg(F.min(order).alias("row"))
              .select("row._h1", "row._h2"))
    # Of equal rows one goes over the shuffle for each task, and one is kept.
    same = Window.partitionBy("_h1", "_h2").orderBy("_h1")
    rows = (df.select(F.struct(*df.columns).alias("row"), *(c.alias(n) for n, c in hashes.items()))
            .withColumn("nth", F.row_number().over(same)).where("nth = 1"))
    return rows.join(chosen, ["_h1", "_h2"], "left_semi").select("row.*")
