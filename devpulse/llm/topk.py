"""Exact top-k inner-product search over norm-sorted, rotated vectors.

Vectors are quantised to integers, so scores are exact. They are dealt to
blocks by descending length (range partitioning on length, key and row, so
equal lengths are split too). A query's threshold starts from its scores against
the ``SEEDS`` longest vectors. A query goes only to the blocks whose longest
vector can still reach the threshold (Cauchy-Schwarz), which are the first so
many: one number a query. A task holds a block and streams the queries that
reach it past, so that a vector goes over the network once. Inside, vectors come
in descending length; the first rotated components give a partial sum, the
lengths of the rests bound what is missing, and only vectors whose bound reaches
the threshold get an exact integer score. The bounds of a chunk come from one
single-precision product; what rounding may add to them is allowed for. The
rotation comes from a singular value decomposition of about ``ROTATION_ROWS``
vectors, and the number of components in the partial sum is the one with the
least work on these; any rotation and number give the same results. The driver
gets one length for each block of ``BLOCK`` vectors.

Defined results: vectors that are null or hold null or non-finite components,
and rows without a key, take no part. Vectors are compared with those of the
same number of components. Rows with the query's key are never its candidates;
other repeated rows are candidates each. A key on several rows is one query: a
candidate row counts once, with the best score of the key's vectors. Ties go to
the smaller key. Scores are 64-bit integers: components beyond 2**31 may
overflow them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devpulse.llm.streams import hold_and_stream
from devpulse.plans.staging import stage_table

SEEDS = 1024
ROTATION_ROWS = 8192
BLOCK = 65_536
#: Vectors, and queries, that meet at a time.
CHUNK = 1024
#: A block's vectors that meet them at a time in the end.
LONG_CHUNK = 4096
#: From one in so many pairs within their bounds on, all pairs of a chunk are scored by one product.
DENSE = 16
#: What scoring one pair costs a component, in components of a bound, about.
PAIR_COST = 200
HEAD_QUERIES = 128
LOWEST = np.iinfo(np.int64).min
FOUND = "query_id long, vec_id long, row long, score long"


def quantised(df: DataFrame, scale: int, key: str, vector: str) -> DataFrame:
    """``vec_id, v, norm``: floor(scale * x) of every usable vector."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("long"))
    return (df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~bad)
            .select(F.col(key).cast("long").alias("vec_id"), whole.alias("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def _keep_best(owner: np.ndarray, score: np.ndarray, vec: np.ndarray, row: np.ndarray, k: int):
    """The k best of each owner, ties to the smaller key, sorted by owner."""
    order = np.lexsort((row, vec, -score, owner))
    owner = owner[order]
    keep = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left") < k
    return owner[keep], *(c[order][keep] for c in (score, vec, row))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The integer products of all pairs, by floating point where it holds every partial sum exactly."""
    most = _lengths(q).max(initial=0) * _lengths(x).max(initial=0) * (1 + 1e-9)
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return q.astype(kind) @ x.astype(kind).T


def _lengths(v: np.ndarray) -> np.ndarray:
    return np.linalg.norm(v.astype(float), axis=1)


def _side(v: np.ndarray, rotation: np.ndarray, head: int) -> np.ndarray:
    """The first rotated components and the length of the rest: two sides' product bounds the score, up to ``_slack``."""
    turned = v @ rotation
    side = np.column_stack([turned[:, :head], np.linalg.norm(turned[:, head:], axis=1)])
    return side.astype(np.float32) if np.abs(side).max(initial=0) < 2.0**60 else side


def _slack(head: int) -> float:
    """What rounding adds to a bound at most, as a share of the two lengths' product."""
    return 1e-9 + (head + 8) * 2.0**-23


def _search(q_id, q, theta, x_id, x, x_row, x_len, x_side, rotation, head, k):
    """Top k of each query among vectors sorted by descending length, at or above the thresholds: the query's
    number, score, key, row."""
    q_len, q_side, slack = _lengths(q), _side(q, rotation, head), _slack(head)
    found = (np.empty(0, np.int64),) * 4
    theta, last = theta.copy(), np.full(len(q), np.iinfo(np.int64).max)  # the worst score and key that may still enter
    a, step = 0, CHUNK
    while a < len(x):
        part, ids, rows = (c[a:a + step] for c in (x, x_id, x_row))
        off = slack * q_len * x_len[a] + 1e-6
        active = np.flatnonzero(q_len * x_len[a] + off >= theta)
        if not len(active):
            break
        bound = q_side[active] @ x_side[a:a + step].T
        need = np.nextafter((theta - off)[active].astype(bound.dtype), bound.dtype.type(-np.inf))
        reach = bound >= need[:, None]
        if np.count_nonzero(reach) * DENSE > reach.size:
            score = _products(q[active], part)
            least = theta[active].astype(score.dtype)[:, None]
            reach = (score > least) | ((score == least) & (ids <= last[active][:, None]))
            at = np.flatnonzero(reach)
            score = score.ravel()[at].astype(np.int64)
            i, j = active[at // len(part)], at % len(part)
        else:
            at = np.flatnonzero(reach)
            i, j = active[at // len(part)], at % len(part)
            score = np.concatenate([np.einsum("ij,ij->i", q[i[s:s + 65536]], part[j[s:s + 65536]])
                                    for s in range(0, max(1, len(i)), 65536)])
        enter = (score > theta[i]) | ((score == theta[i]) & (ids[j] <= last[i]))
        i, j, score = (c[enter & (q_id[i] != ids[j])] for c in (i, j, score))
        a, step = a + step, min(2 * step, LONG_CHUNK)
        if not len(i):
            continue
        found = _keep_best(*(np.concatenate(p) for p in zip(found, (i, score, ids[j], rows[j]))), k)
        owner, n = np.unique(found[0], return_counts=True)
        full, kth = owner[n == k], np.cumsum(n)[n == k] - 1
        theta[full], last[full] = found[1][kth], found[2][kth]
    return found


def top_k(df: DataFrame, is_query: Column, k: int, scale: int = 256, key: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best other vectors for each row where ``is_query``.

    ``is_query`` is a condition on the key column, named ``vec_id`` here.
    """
    spark = df.sparkSession
    vectors = stage_table(quantised(df, scale, key, vector).withColumn("row", F.monotonically_increasing_id()), "vectors")
    vectors = vectors.withColumn("dim", F.size("v"))
    out = spark.createDataFrame([], FOUND)
    for r in vectors.groupBy("dim").agg(F.count("*").alias("n")).orderBy("dim").collect():
        out = out.union(_top_k_of(vectors.where(F.col("dim") == r["dim"]), r["n"], r["dim"], is_query, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "row")
    return (out.groupBy("query_id", "vec_id", "row").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _rotation(vectors: DataFrame, n: int, dim: int, k: int) -> tuple[np.ndarray, int]:
    """An orthogonal matrix with the directions of most energy first, and how many of these the bounds shall use."""
    every = max(1, n // ROTATION_ROWS)
    sample = _matrix(vectors.where(F.pmod(F.xxhash64("row"), F.lit(every)) == 0).select("v")
                     .limit(2 * ROTATION_ROWS).toArrow()["v"]).astype(float)
    if not dim or not sample.any():
        return np.eye(dim), dim
    # The triangular factor has the sample's right singular vectors and at most dim rows.
    rotation = np.linalg.svd(np.linalg.qr(sample, mode="r"), full_matrices=True)[2].T
    return rotation, _head(sample @ rotation, k)


def _head(sample: np.ndarray, k: int) -> int:
    """The number of rotated components with the least work on a sample: a bound's own components, and the scoring of
    the pairs within it."""
    dim, some = sample.shape[1], sample[:HEAD_QUERIES]
    best = np.partition(some @ sample.T, max(0, len(sample) - k - 1), axis=1)[:, max(0, len(sample) - k - 1)]

    def work(head: int) -> float:
        rests = (np.linalg.norm(v[:, head:], axis=1) for v in (some, sample))
        bound = some[:, :head] @ sample[:, :head].T + np.outer(*rests)
        return head + PAIR_COST * dim * np.mean(bound + _slack(head) * np.abs(best).max() >= best[:, None])

    return min(sorted({-(-dim * part // 8) for part in range(1, 9)}), key=work)


def _top_k_of(vectors: DataFrame, n: int, dim: int, is_query: Column, k: int) -> DataFrame:
    rotation, head = _rotation(vectors, n, dim, k)
    longest = vectors.orderBy(F.desc("norm"), "vec_id", "row").limit(SEEDS).select("vec_id", "v").toArrow()
    seed_id, seeds = longest["vec_id"].to_numpy(), _matrix(longest["v"])

    def thresholds(batches):
        for whole in batches:
            for s in range(0, len(whole), CHUNK):
                batch = whole.slice(s, CHUNK)
                ids, q = batch.column(0).to_numpy(), _matrix(batch.column(1))
                score = _products(q, seeds).astype(np.int64)
                score[ids[:, None] == seed_id[None, :]] = LOWEST
                theta = (np.partition(score, -k, axis=1)[:, -k] if len(seed_id) >= k
                         else np.full(len(ids), LOWEST))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(theta)], ["vec_id", "v", "norm", "theta"])

    blocks = -(-n // BLOCK)
    dealt = stage_table(vectors.repartitionByRange(blocks, F.desc("norm"), "vec_id", "row")
                        .select("vec_id", "v", "norm", "row", F.spark_partition_id().alias("block")), "blocks")
    limits = dealt.groupBy("block").agg(F.max("norm").alias("longest")).orderBy("block").collect()
    block, length = np.array([r["block"] for r in limits]), np.array([r["longest"] for r in limits])

    def reaching(batches):
        """A query once for each block within its reach."""
        for batch in batches:
            norm, theta = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            need = np.divide(theta, norm, out=np.zeros(len(norm)), where=(theta > 0) & (norm > 0))
            within = np.searchsorted(-(length * (1 + 1e-9) + 1e-6), -need, side="right")
            for s in range(0, len(blocks_of := np.repeat(np.arange(len(within)), within)), CHUNK):
                own = blocks_of[s:s + CHUNK]
                nth = np.arange(s, s + len(own)) - (np.cumsum(within) - within)[own]
                columns = (batch.column(i).take(pa.array(own)) for i in (0, 1, 3))
                yield pa.RecordBatch.from_arrays([pa.array(block[nth], pa.int32()), *columns], ["block", "vec_id", "v", "theta"])

    queries = (vectors.where(is_query).select("vec_id", "v", "norm").dropDuplicates(["vec_id", "v"])
               .mapInArrow(thresholds, "vec_id long, v array<long>, norm double, theta long")
               .mapInArrow(reaching, "block int, vec_id long, v array<long>, theta long"))

    def search(held: pa.Table):
        held = held.sort_by([("norm", "descending"), ("vec_id", "ascending")])
        x_id, x_row, x = held["vec_id"].to_numpy(), held["row"].to_numpy(), _matrix(held["v"])
        x_len, x_side = _lengths(x), _side(x, rotation, head)

        def through(whole):
            for s in range(0, len(whole), CHUNK):
                batch = whole.slice(s, CHUNK)
                ids = batch.column("vec_id").to_numpy()
                i, score, vec, rows = _search(ids, _matrix(batch.column("v")), batch.column("theta").to_numpy(),
                                              x_id, x, x_row, x_len, x_side, rotation, head, k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[i], vec, rows, score)],
                                                 ["query_id", "vec_id", "row", "score"])

        return through

    null = F.lit(None).cast("long")
    return hold_and_stream(dealt.select("block", "vec_id", "v", "norm", "row", null.alias("theta")),
                           queries.select("block", "vec_id", "v", null.cast("double").alias("norm"), null.alias("row"), "theta"),
                           "block", FOUND, search)
