"""Approximate nearest neighbours by multiprobe p-stable hashing.

1. Usable rows are collapsed by (key, vector); of one vector only as many keys
   stay as can be in a result (``k`` + 1), so a vector on a third of all rows
   is searched once. Equal query vectors are one search, too.
2. Vectors are scaled by the longest and get one component more that brings all
   to length one, so that the largest inner product is the smallest distance.
   A table has ``m`` functions floor((a x + b) / w) with normal a (2-stable) and
   w twice the projections' deviation, clipped to four slots: two bits each of
   the bucket's code. ``TABLES`` tables are dealt to shards by ranges of
   (code, row hash), so that a full bucket spreads over shards.
3. A query visits buckets in the order of their estimated success: the product
   over the functions of the chance that a neighbour's projection, normal
   around a share of the query's own, falls into the slot. Share and spread come
   from the exact neighbours of at most ``FIT_QUERIES`` queries, searched
   against all rows; so do ``m`` and the number of probes: the finest codes for
   which at most ``PROBES`` visits a table reach ``RECALL`` of these neighbours.
   One function with all its slots visits everything, so some ``m`` always does.
4. A task holds a shard and streams the queries that visit it past; every
   visited bucket is scored whole, what may enter the best is scored again pair
   by pair in double precision. The tables' candidates are merged without
   repeats, expanded to rows and ranked.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and rows without a key, take no part. Vectors are compared with
those of the same number of components. Rows with the query's key are never its
candidates; other repeated rows are candidates each. A key on several rows is
one query with the best of its vectors' scores. Ties go to the smaller key. An
empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devpulse.llm.streams import hold_and_stream
from devpulse.plans.staging import stage_table

TABLES = 4
SLOTS = 4
#: Recall aimed at on the queries of the fit, their number, and rows the hash functions are fitted on.
RECALL = 0.95
FIT_QUERIES = 256
FIT_ROWS = 8192
#: Visits a table at most, and functions a table at most.
PROBES = 1024
FUNCTIONS = 24
#: Rows of a shard, shards of a table at most, rows that set the shards' borders.
SHARD = 16_384
MAX_SHARDS = 1 << 14
BORDER_ROWS = 16
#: Queries that pass a shard before it is held once more by another task.
PASSING = 1 << 18
SEED = 42
FOUND = "p1 long, p2 long, vec_id long, e long, copies long, score double"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, v, dim, copies, p1, p2``: a row for each key and vector; p1 and p2 are hashes of the vector."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(vector, lambda x: x != 0)
    return (df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~bad & ~zero)
            .select(F.col(key).cast("long").alias("vec_id"),
                    F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
            .groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
            .select("vec_id", "v", F.size("v").alias("dim"), "copies",
                    F.xxhash64(F.lit(1), "v").alias("p1"), F.xxhash64(F.lit(2), "v").alias("p2")))


def _keep(query: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """Places of what any key's k best others may need, sorted by query: of each query the k best rows of every
    key, down to the key that comes k + 1st."""
    order = np.lexsort((vec, -score, query))
    q, v = query[order], vec[order]
    by_key = np.lexsort((np.arange(len(q)), v, q))
    first = np.r_[True, (q[by_key][1:] != q[by_key][:-1]) | (v[by_key][1:] != v[by_key][:-1])]
    starts = np.flatnonzero(first)
    nth = np.empty(len(q), np.int64)
    nth[by_key] = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    new = np.cumsum(nth == 0)
    begin = np.searchsorted(q, q)
    return order[(nth < k) & (new - new[begin] <= k)]


class Hashing:
    """One table's functions, fitted to rows and to pairs of queries and their neighbours."""

    def __init__(self, rows: np.ndarray, near: tuple[np.ndarray, np.ndarray], m: int, seed: int):
        rng = np.random.default_rng([SEED, seed])
        self.a = rng.normal(size=(rows.shape[1], m))
        self.a /= np.linalg.norm(self.a, axis=0)
        projected = rows @ self.a
        self.w = 2 * np.maximum(projected.std(0), 1e-9)
        self.b = rng.random(m) * self.w - projected.mean(0)
        query, other = near[0] @ self.a, near[1] @ self.a
        self.share = (query * other).sum(0) / np.maximum((query * query).sum(0), 1e-12)
        self.spread = np.maximum((other - self.share * query).std(0), 1e-6)

    def slots(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((x @ self.a + self.b) / self.w) + SLOTS // 2, 0, SLOTS - 1).astype(np.int64)

    def codes(self, x: np.ndarray) -> np.ndarray:
        code = np.zeros(len(x), np.int64)
        for s in self.slots(x).T:
            code = code * SLOTS + s
        return code

    def costs(self, q: np.ndarray) -> np.ndarray:
        """-log of the chance that a neighbour's slot is s: queries x functions x slots."""
        middle = (q @ self.a) * self.share + self.b
        edges = (np.arange(1, SLOTS) - SLOTS // 2) * self.w[:, None]
        below = _normal((edges[None] - middle[:, :, None]) / self.spread[None, :, None])
        chance = np.diff(np.concatenate([np.zeros((*middle.shape, 1)), below, np.ones((*middle.shape, 1))], axis=2), axis=2)
        return -np.log(np.maximum(chance, 1e-12))

    def probes(self, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The codes of each query's n likeliest buckets, likeliest first, and their costs.

        Costs add up, so the n best prefixes of the functions are all that the n best codes need.
        """
        code, cost = np.zeros((len(q), 1), np.int64), np.zeros((len(q), 1))
        for own in self.costs(q).transpose(1, 0, 2):
            cost = (cost[:, :, None] + own[:, None, :]).reshape(len(q), -1)
            code = (code[:, :, None] * SLOTS + np.arange(SLOTS)).reshape(len(q), -1)
            if cost.shape[1] > n:
                best = np.argpartition(cost, n - 1, axis=1)[:, :n]
                code, cost = np.take_along_axis(code, best, 1), np.take_along_axis(cost, best, 1)
        order = np.argsort(cost, axis=1, kind="stable")
        return np.take_along_axis(code, order, 1), np.take_along_axis(cost, order, 1)


def _normal(z: np.ndarray) -> np.ndarray:
    """Normal distribution function (Abramowitz and Stegun 26.2.17, error under 1e-7)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (
        -0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z > 0, 1 - tail, tail)


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows scaled by the longest, with the component that brings them to length one."""
    x = x / longest
    return np.c_[x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))]


def aimed(q: np.ndarray) -> np.ndarray:
    """Queries of length one with the component more."""
    return np.c_[q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(len(q))]


def fit(rows: np.ndarray, queries: np.ndarray, neighbours: np.ndarray, owner: np.ndarray, n: int, recall: float):
    """Tables and probes: the finest codes whose first ``PROBES`` visits find ``recall`` of the neighbours.

    ``rows`` and ``neighbours`` are lifted, ``queries`` aimed; neighbour i belongs to query ``owner[i]``.
    """
    finest = min(FUNCTIONS, max(1, round(math.log2(max(2, n / 16)) / 1.4)))
    for m in range(finest, 0, -1):
        tables = [Hashing(rows, (queries[owner], neighbours), m, t) for t in range(TABLES)]
        most = min(PROBES, SLOTS**m)
        rank = np.full(len(owner), most)
        for t in tables:
            visited, _ = t.probes(queries, most)
            hit = visited[owner] == t.codes(neighbours)[:, None]
            rank = np.minimum(rank, np.where(hit.any(1), hit.argmax(1), most))
        needed = int(np.sort(rank)[max(0, math.ceil(recall * len(rank)) - 1)]) + 1 if len(rank) else most
        if needed <= most or m == 1:
            return tables, min(needed, most)
    raise AssertionError("one function reaches everything")


def _neighbours(rows: DataFrame, q: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors with the k largest inner products for each of a few queries, by a search over all rows,
    and the queries' numbers. ``own`` is the hash p1 of a query's vector, which is not among them."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            score = q @ x.T
            score[own[:, None] == batch.column(1).to_numpy()] = -np.inf
            best = np.argpartition(-score, min(k, len(x)) - 1, axis=1)[:, :k]
            at, kept = np.repeat(np.arange(len(q)), best.shape[1]), best.ravel()
            real = np.isfinite(score[at, kept])
            at, kept = at[real], kept[real]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(score[at, kept]), batch.column(0).take(pa.array(kept))], ["q", "score", "v"])

    best = Window.partitionBy("q").orderBy(F.desc("score"))
    found = (rows.select("v", "p1").mapInArrow(run, "q int, score double, v array<double>")
             .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k).select("q", "v").toArrow())
    return _matrix(found["v"]), found["q"].to_numpy()


def _search_shard(held: pa.Table, k: int):
    """Scores the visited buckets of a shard for batches of queries."""
    held = held.sort_by([("code", "ascending")])
    code, vec, e, copies = (held[c].to_numpy() for c in ("code", "vec_id", "e", "copies"))
    x = _matrix(held["v"])
    bucket, start = np.unique(code, return_index=True)
    end = np.r_[start[1:], len(code)]

    def through(batch: pa.RecordBatch):
        q = _matrix(batch.column("v"))
        visits = batch.column("codes")
        owner = np.repeat(np.arange(len(q)), np.diff(visits.offsets.to_numpy()))
        wanted = visits.flatten().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(bucket, wanted), len(bucket) - 1)
        there = bucket[at] == wanted
        owner, at = owner[there], at[there]
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        least = np.full(len(q), -np.inf)
        kept, found = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)), []

        def merge():
            nonlocal kept, found
            i, j = (np.concatenate(c) for c in zip(*found))
            score = np.concatenate([np.einsum("ij,ij->i", q[i[s:s + 65536]], x[j[s:s + 65536]])
                                    for s in range(0, len(i), 65536)])
            i, score, j = (np.concatenate(p) for p in zip(kept, (i, score, j)))
            best = _keep(i, score, vec[j], k)
            kept, found = (i[best], score[best], j[best]), []
            keys, last, count = np.unique(kept[0][::-1], return_index=True, return_counts=True)
            enough = count >= k * (k + 1)  # sure to hold k + 1 keys, or k of each
            distinct = np.zeros(len(q), np.int64)
            pairs = np.unique(np.c_[kept[0], vec[kept[2]]], axis=0)[:, 0]
            np.add.at(distinct, pairs, 1)
            enough |= distinct[keys] > k
            least[keys[enough]] = kept[1][::-1][last[enough]] - 1e-9

        held_pairs = 0
        borders = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
        for a, z in zip(borders, np.r_[borders[1:], len(at)]):
            who, s, t = owner[a:z], start[at[a]], end[at[a]]
            score = q[who] @ x[s:t].T
            i, j = np.nonzero(score >= least[who][:, None])
            if len(i):
                found.append((who[i], s + j))
                held_pairs += len(i)
            if held_pairs > 1 << 18:
                merge()
                held_pairs = 0
        if found:
            merge()
        i, score, j = kept
        yield pa.RecordBatch.from_arrays(
            [batch.column("p1").take(pa.array(i)), batch.column("p2").take(pa.array(i)), pa.array(vec[j]), pa.array(e[j]),
             pa.array(copies[j]), pa.array(score)], ["p1", "p2", "vec_id", "e", "copies", "score"])

    return through


def _nearest_of(rows: DataFrame, searched: DataFrame, k: int, recall: float) -> DataFrame:
    """``FOUND`` for vectors of one number of components."""
    n, longest = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()

    def some(df: DataFrame, size: int, total: int) -> tuple[np.ndarray, np.ndarray]:
        every = F.lit(max(1, total // size))
        chosen = F.pmod(F.xxhash64("p1", "p2"), every) == F.pmod(F.xxhash64(F.lit("some")), every)
        found = df.where(chosen).select("v", "p1").limit(2 * size).toArrow()
        if not len(found):  # by chance, of few
            found = df.select("v", "p1").limit(size).toArrow()
        return _matrix(found["v"]), found["p1"].to_numpy()

    (sample, _), (few, own) = some(rows, FIT_ROWS, n), some(searched, FIT_QUERIES, searched.count())
    near, owner = _neighbours(rows, few, own, k)
    if len(near):
        tables, probes = fit(lifted(sample, longest), aimed(few), lifted(near, longest), owner, n, recall)
    else:
        tables, probes = [Hashing(lifted(sample, longest), (aimed(few), aimed(few)), 1, 0)], SLOTS

    def coded(batches):
        """Each row's codes and the hash that orders rows of a code."""
        for batch in batches:
            x = lifted(_matrix(batch.column(0)), longest) if len(batch) else np.empty((0, len(tables[0].a)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([t.codes(x) for t in tables])), pa.array(np.repeat(np.arange(len(tables)), len(x)), pa.int32()),
                 *(pa.concat_arrays([c] * len(tables)) for c in batch.columns)],
                ["code", "tab", "v", "vec_id", "e", "copies", "salt"])

    dealt = rows.select("v", "vec_id", F.col("p1").alias("e"), "copies", F.xxhash64("vec_id", "p2").alias("salt"))
    coded_rows = dealt.mapInArrow(coded, "code long, tab int, v array<double>, vec_id long, e long, copies long, salt long")
    shards = min(MAX_SHARDS, -(-n // SHARD))
    every = max(1, n // (shards * BORDER_ROWS * 4))
    edge = (coded_rows.where(F.pmod(F.xxhash64("salt"), F.lit(every)) == 0).select("tab", "code", "salt").toArrow()
            if shards > 1 else None)
    borders = []
    for t in range(len(tables)):
        if edge is None:
            borders.append((np.empty(0, np.int64), np.empty(0, np.int64)))
            continue
        mine = edge.filter(pa.compute.equal(edge["tab"], t))
        c, s = mine["code"].to_numpy(), mine["salt"].to_numpy()
        order = np.lexsort((s, c))
        cut = order[np.unique((np.arange(1, shards) * len(order)) // shards)] if len(order) else order
        borders.append((c[cut], s[cut]))
    base = np.cumsum([0, *(len(b[0]) + 1 for b in borders)])

    def visiting(batches):
        """A query once for each shard that holds any of its buckets, with these."""
        for whole in batches:
            for s in range(0, len(whole), 256):
                batch = whole.slice(s, 256)
                q = aimed(_matrix(batch.column(0)))
                for t, table in enumerate(tables):
                    codes, _ = table.probes(q, probes)
                    codes = np.sort(codes, axis=1)
                    low = np.searchsorted(borders[t][0], codes, side="left")
                    high = np.searchsorted(borders[t][0], codes, side="right")
                    span = (high - low + 1).ravel()
                    who = np.repeat(np.repeat(np.arange(len(q)), codes.shape[1]), span)
                    code = np.repeat(codes.ravel(), span)
                    nth = np.arange(len(code)) - np.repeat(np.cumsum(span) - span, span)
                    shard = np.repeat(low.ravel(), span) + nth
                    order = np.lexsort((code, shard, who))
                    who, shard, code = who[order], shard[order], code[order]
                    new = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (shard[1:] != shard[:-1])])
                    lists = pa.ListArray.from_arrays(pa.array(np.r_[new, len(code)].astype(np.int32)), pa.array(code))
                    own = pa.array(who[new])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(base[t] + shard[new], pa.int32()), lists, *(batch.column(i).take(own) for i in range(3))],
                        ["shard", "codes", "v", "p1", "p2"])

    passing = stage_table(searched.select("v", "p1", "p2").mapInArrow(
        visiting, "shard int, codes array<long>, v array<double>, p1 long, p2 long"), "ann-visits")
    visits = {r["shard"]: r["n"] for r in passing.groupBy("shard").agg(F.count("*").alias("n")).where(
        F.col("n") > PASSING).collect()}
    turns = np.ones(int(base[-1]), np.int64)
    for s, count in visits.items():
        turns[s] = -(-count // PASSING)
    first = np.cumsum(np.r_[0, turns])

    def placed(batches):
        for batch in batches:
            tab, code, salt = (batch.column(c).to_numpy() for c in ("tab", "code", "salt"))
            shard = np.empty(len(batch), np.int64)
            for t, (c, s) in enumerate(borders):
                mine = np.flatnonzero(tab == t)
                # The border's place by code, then by salt among borders of one code.
                low, high = np.searchsorted(c, code[mine], side="left"), np.searchsorted(c, code[mine], side="right")
                at = low.copy()
                for i in np.flatnonzero(high > low):
                    at[i] += np.searchsorted(s[low[i]:high[i]], salt[mine[i]], side="right")
                shard[mine] = base[t] + at
            rows_of = np.repeat(np.arange(len(batch)), turns[shard])
            nth = np.arange(len(rows_of)) - np.repeat(np.cumsum(turns[shard]) - turns[shard], turns[shard])
            take = pa.array(rows_of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first[shard[rows_of]] + nth), *(batch.column(c).take(take) for c in ("code", "v", "vec_id", "e", "copies"))],
                ["block", "code", "v", "vec_id", "e", "copies"])

    def turned(batches):
        for batch in batches:
            shard = batch.column(0).to_numpy()
            turn = batch.column(3).to_numpy().view(np.uint64) % turns[shard].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(first[shard] + turn.astype(np.int64)), *batch.columns[1:]],
                                             ["block", *batch.schema.names[1:]])

    blank = {"codes": "array<long>", "p1": "long", "p2": "long", "code": "long", "vec_id": "long", "e": "long", "copies": "long"}

    def padded(df: DataFrame) -> DataFrame:
        return df.select("block", "v", *(F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in blank.items()))

    held = coded_rows.mapInArrow(placed, "block long, code long, v array<double>, vec_id long, e long, copies long")
    asks = passing.mapInArrow(turned, "block long, codes array<long>, v array<double>, p1 long, p2 long")
    return hold_and_stream(padded(held), padded(asks), "block", FOUND, lambda table: _search_shard(table, k))


def nearest(df: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding",
            recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest other vectors found for each row where ``is_query``.

    ``is_query`` is a condition on the key column, named ``vec_id`` here.
    """
    spark = df.sparkSession
    rows = stage_table(usable(df, key, vector), "ann-vectors")
    first = Window.partitionBy("p1", "p2").orderBy("vec_id")
    candidates = stage_table(rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1).drop("nth"),
                             "ann-candidates")
    asking = rows.where(is_query)
    searched = stage_table(asking.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth"), "ann-searched")
    found = spark.createDataFrame([], FOUND)
    for r in searched.select("dim").distinct().orderBy("dim").collect():
        of = F.col("dim") == r["dim"]
        found = found.union(_nearest_of(candidates.where(of), searched.where(of), k, recall))
    # A candidate may come from several tables, and to one key from several vectors.
    merged = (found.join(asking.select(F.col("vec_id").alias("query_id"), "p1", "p2"), ["p1", "p2"])
              .where("vec_id <> query_id").groupBy("query_id", "vec_id", "e").agg(F.max("copies").alias("copies"),
                                                                                 F.max("score").alias("score")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "e")
    each = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int")))
    return (merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "vec_id", "e", "score", each.alias("copy"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
