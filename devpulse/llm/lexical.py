"""Ranked lexical search of many items at once by common-subexpression evaluation.

1. The items' distinct terms are read in blocks of about ``BLOCK_TERMS`` (item,
   term) pairs; a block's terms and what follows from them reach the driver, the
   documents never do.
2. One map over the documents notes, for every document with a term, its length
   and how often each of the block's terms occurs. This table is written; it
   gives the corpus figures (documents, terms, documents of each term).
3. Shared term sets are mined from the block: the pair of sets that stands
   together in most items becomes a set of its own, again and again, as long as
   two items share one. The result is a directed acyclic graph in which an
   accumulator is the sum of two others and an item the sum of a few.
4. A second map, over the written table, materialises the accumulators of a
   slice of documents, each once, in the graph's order, and sums them to the
   items' scores. A task keeps the best rows of every item; these meet in a
   window with a limit on both sides of the shuffle.

Scores are 64-bit integers: sums in any order are exact.

Defined results: a null or empty text has no terms; it is no document of the
corpus figures and never a result. Rows of one item are one item with the terms
of all; a null item is an item. An item without known terms has no rows.
Repeated documents are ranked each; equal scores go to the smaller key, null
keys last. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.llm.batches import slices
from devpulse.plans.staging import stage_table

#: (item, term) pairs in a block of items, about.
BLOCK_TERMS = 50_000
#: Bytes of accumulators of a slice of documents, about; collected results between two clean-ups.
SLICE = 32 << 20
KEPT = 1 << 18
#: A-Z to lower case, other ASCII but letters and digits to spaces; all other bytes stay.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order: runs of letters, digits and non-ASCII code points."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item, term``: the distinct terms of every item."""

    def run(batches):
        for batch in slices(batches, 1):
            found = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array([t for f in found for t in f], pa.binary())], ["item", "term"])

    schema = T.StructType([T.StructField("item", items.schema[key].dataType), T.StructField("term", T.BinaryType())])
    return (items.select(F.col(key).alias("item"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, schema).distinct())


def profiles(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """``key, n, terms, times`` for every document with a term: its length, the known terms and their occurrences."""

    def run(batches):
        get, size = vocabulary.get, max(1, len(vocabulary))
        for batch in slices(batches, 1):
            n, known = [], []
            for t in batch.column(1).to_pylist():
                listed = terms(t)
                n.append(len(listed))
                known.append([v for v in map(get, listed) if v is not None])
            n = np.array(n, np.int64)
            rows = np.repeat(np.arange(len(n)), [len(k) for k in known])
            pairs, times = np.unique(rows * size + np.concatenate([*map(np.array, known), []]).astype(np.int64),
                                     return_counts=True)
            some = np.flatnonzero(n)
            ends = np.searchsorted(pairs, (some + 1) * size)
            offsets = pa.array(np.r_[0, ends].astype(np.int32))
            lists = (pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (pairs % size, times))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), pa.array(n[some]), *lists],
                                             ["key", "n", "terms", "times"])

    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("times", T.ArrayType(T.IntegerType()))])
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def sharing_graph(sets: Sequence[Sequence[int]], size: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Sums of two accumulators (``size``, ``size`` + 1, ... in order) and the accumulators that make up each set.

    ``sets`` holds numbers below ``size``: the accumulators of the terms. The pair that most sets hold is
    summed first (ties: the smaller numbers), as long as two sets hold it.
    """
    holds = [set(s) for s in sets]
    where: dict[int, set[int]] = {}
    for i, s in enumerate(holds):
        for a in s:
            where.setdefault(a, set()).add(i)
    found = Counter((a, b) for s in holds for a in s for b in s if a < b and len(where[a]) > 1 and len(where[b]) > 1)
    heap = [(-n, a, b) for (a, b), n in found.items() if n > 1]
    heapq.heapify(heap)
    sums: list[tuple[int, int]] = []
    while heap:
        n, a, b = heapq.heappop(heap)
        both = where[a] & where[b]
        if len(both) < 2:
            continue
        if len(both) < -n:  # some of them have joined other sums since
            heapq.heappush(heap, (-len(both), a, b))
            continue
        new = size + len(sums)
        sums.append((a, b))
        where[a] -= both
        where[b] -= both
        where[new] = both
        beside: Counter = Counter()
        for i in both:
            holds[i] -= {a, b}
            beside.update(holds[i])
            holds[i].add(new)
        for c, n in beside.items():
            if n > 1:
                heapq.heappush(heap, (-n, c, new))
    return sums, [sorted(s) for s in holds]


def additions(sets: Sequence[Sequence[int]], sums: Sequence[tuple[int, int]], parts: Sequence[Sequence[int]]) -> tuple[int, int]:
    """Additions a document without and with the graph."""
    return sum(max(0, len(s) - 1) for s in sets), len(sums) + sum(max(0, len(p) - 1) for p in parts)


def _best(rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of each item."""
    rows = rows.take(pa.compute.sort_indices(rows, [("item", "ascending"), ("score", "descending"), ("key", "ascending")]))
    item = rows["item"].to_numpy()
    return rows.filter(pa.array(np.arange(len(item)) - np.searchsorted(item, item) < k))


def _flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _scored(batches: Iterator[pa.RecordBatch], weight: np.ndarray, sums, parts, k: int, docs: int, length: int):
    """The k best rows of each item in a task: ``item`` (its number), ``key``, ``score``."""
    size, items = len(weight), len(parts)
    step = max(16, SLICE // (8 * (size + len(sums) + items + 1)))
    least = np.ones(items, np.int64)
    kept: list[pa.Table] = []
    for whole in batches:
        for start in range(0, len(whole), step):
            batch = whole.slice(start, step)
            m = 50 + 50 * batch.column(1).to_numpy() * docs // length
            term, times = _flat(batch.column(2)), _flat(batch.column(3)).astype(np.int64)
            row = np.repeat(np.arange(len(batch)), np.diff(batch.column(2).offsets.to_numpy()))
            partial = np.zeros((size + len(sums), len(batch)), np.int64)
            partial[term, row] = weight[term] * (1_000_000_000 * times // (1000 * times + 20 * m[row]))
            for i, (a, b) in enumerate(sums, size):
                np.add(partial[a], partial[b], out=partial[i])
            score = np.stack([partial[p].sum(0) for p in parts])
            item, row = np.nonzero(score >= least[:, None])
            kept.append(pa.table({"item": pa.array(item, pa.int32()), "key": batch.column(0).take(pa.array(row)),
                                  "score": pa.array(score[item, row])}))
            if sum(map(len, kept)) > max(KEPT, 2 * k * items):
                kept = [_best(pa.concat_tables(kept), k)]
                item, n = np.unique(kept[0]["item"].to_numpy(), return_counts=True)
                full = n == k
                least[item[full]] = kept[0]["score"].to_numpy()[np.cumsum(n)[full] - 1]
    if kept:
        yield from _best(pa.concat_tables(kept), k).combine_chunks().to_batches()


def weights(counts: dict[int, int], size: int, docs: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of every term."""
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * counts.get(t, 0) + 1))) for t in range(size)], np.int64)


def _search_block(docs: DataFrame, block: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """The results of one block of ``item, term`` pairs."""
    spark = docs.sparkSession
    listed = block.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms")).collect()
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in listed for t in r["terms"]}))}
    sets = [[vocabulary[bytes(t)] for t in r["terms"]] for r in listed]
    found = stage_table(profiles(docs, vocabulary, key, text), "lexical-profiles")
    corpus = found.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    counts = {r["t"]: r["n"] for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
    weight = weights(counts, len(vocabulary), corpus["docs"])
    sums, parts = sharing_graph(sets, len(vocabulary))
    docs_n, length = corpus["docs"], max(1, corpus["length"])

    def run(batches):
        return _scored(batches, weight, sums, parts, k, docs_n, length)

    kind = T.StructField("key", docs.schema[key].dataType)
    schema = T.StructType([T.StructField("item", T.IntegerType()), kind, T.StructField("score", T.LongType())])
    names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(listed)],
                                  T.StructType([T.StructField("item", T.IntegerType()),
                                                T.StructField("item_id", block.schema["item"].dataType)]))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return (found.mapInArrow(run, schema).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .join(F.broadcast(names), "item").select("item_id", "rank", F.col("key").alias(key), "score"))


def search(docs: DataFrame, items: DataFrame, k: int, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, key, score`` of the k best documents with a score above 0 for each item."""
    spark = docs.sparkSession
    pairs = stage_table(item_terms(items, item, item_text), "lexical-items")
    blocks = -(-pairs.count() // BLOCK_TERMS)
    number = F.pmod(F.xxhash64("item"), F.lit(max(1, blocks)))
    out = spark.createDataFrame([], T.StructType([
        T.StructField("item_id", items.schema[item].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.LongType())]))
    for b in range(blocks):  # the corpus is read once a block
        out = out.union(_search_block(docs, pairs.where(number == b), k, key, text))
    return out.withColumnRenamed("item_id", item)
