"""Cross-entropy difference of matched target and background n-gram models.

Both models are word bigrams with the same vocabulary, order and smoothing
and differ only in what they count: the target documents, or all documents.
The vocabulary is every distinct word of all documents, and every word pair is
counted: nothing is cut to a share, so the models grow with the corpus.

``P(w) = (c(w) + 1) / (tokens + vocabulary)`` and ``P(w | u) = BIGRAM *
c(u w) / c(u) + (1 - BIGRAM) * P(w)``; the first word of a document, and one
after a word that the model never saw, has ``P(w)``. ``c(u)`` counts ``u`` at
the end of a document too: the end is a continuation that is not scored.

No model is held in one place. Documents are dealt to chunks of about
``CHUNK_BYTES`` (a longer text is a chunk of its own). A task counts each word
and pair once a chunk; the counts meet by ranges of the item's hash (one entry
a chunk, however often an item occurs there; as many ranges as the text has
``BUCKET_BYTES``) and what the other chunks have of an item returns to each
chunk, in the order it sent its items. A second pass over a chunk's texts adds
up the losses. The driver gets three sizes: bytes, all tokens, the target's
tokens. A document's score is the mean over its tokens of the target loss less
the background loss: lower is closer to the target.

Words are cut at ASCII white space, A-Z lower-cased, and counted by 64-bit
hash. Defined results: a document without words has 0 tokens and null losses
and score; null texts are empty; without target tokens every word has the same
target loss. Documents with a null key are background. Repeated rows count
and score each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.llm.batches import SLICE_BYTES, slices
from devpulse.plans.staging import stage_table

BIGRAM = 0.7
CHUNK_BYTES = 12_000_000
#: Bytes of text for each range of hashes whose counts meet in one group.
BUCKET_BYTES = 8_000_000
#: Bytes hashed at a time.
STRETCH = 1 << 19

_SPACE = np.isin(np.arange(256), list(b"\t\n\v\f\r "))
_BASE = 0x9E3779B97F4A7C15
_WRAP = 1 << 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    return np.r_[np.uint64(1), np.cumprod(np.full(STRETCH - 1, base, np.uint64))]


#: A byte's value, A-Z those of a-z; the base's powers and those of its inverse, all modulo 2^64.
_BYTE = _mix((np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))
_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, _WRAP))


def _long_word(data: np.ndarray) -> np.uint64:
    total = 0
    for at in range(0, len(data), STRETCH):
        part = data[at:at + STRETCH]
        total += int(np.sum(_BYTE[part] * _UP[:len(part)])) * pow(_BASE, at, _WRAP)
    return np.uint64(total % _WRAP)


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in one array and where each begins, with the end of the last."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or edges[-1] == edges[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[edges[0]:edges[-1]], edges - edges[0]


def words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Even hashes of all words of the texts (as of ``_flat``) in order, and the row of each.

    A word's hash is a polynomial over its bytes, taken from running sums over a stretch of text.
    """
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    starts = np.flatnonzero(inside & (cut[:-1] | ~np.r_[False, inside[:-1]]))
    stops = np.flatnonzero(inside & (cut[1:] | ~np.r_[inside[1:], False])) + 1
    hashes = np.empty(len(starts), np.uint64)
    short = stops - starts < STRETCH // 2
    for i in np.flatnonzero(~short):
        hashes[i] = _long_word(data[starts[i]:stops[i]])
    at = np.flatnonzero(short)
    # Half a stretch of starting places at a time: every word of fewer bytes ends inside the stretch.
    for part in np.split(at, np.searchsorted(starts[at], np.arange(STRETCH // 2, len(data), STRETCH // 2))):
        if len(part):
            low = starts[part[0]]
            a, b = starts[part] - low, stops[part] - low
            stretch = data[low:low + b[-1]]
            sums = np.r_[np.uint64(0), np.cumsum(_BYTE[stretch] * _UP[:len(stretch)])]
            hashes[part] = (sums[b] - sums[a]) * _DOWN[a]
    return _mix(hashes) & ~np.uint64(1), np.searchsorted(edges, starts, side="right") - 1


def _pairs(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odd hashes of all pairs of neighbours, and the place of each pair's second word."""
    second = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    return _mix(hashes[second - 1] * np.uint64(_BASE) + (hashes[second] ^ np.uint64(_BASE))) | np.uint64(1), second


def _counts(items: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct items, the place of each occurrence among them, their number and their number in the target."""
    distinct, at, n = np.unique(items, return_inverse=True, return_counts=True)
    return distinct, at, n, np.bincount(at, target, len(distinct)).astype(np.int64)


def _encoded(values: np.ndarray) -> bytes:
    """64-bit values by byte place, compressed: small values and equal high bytes need little."""
    return pa.compress(np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T), "zstd", asbytes=True)


def _decoded(data: bytes, size: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(data, 8 * size, "zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, size).T).view(np.uint64).ravel()


#: A chunk's items of one range of hashes, ascending, as differences, with their counts.
RUN = "bucket long, _chunk long, size int, items binary, n binary, k binary"
#: For the items of a run, in its order, their counts in the other chunks.
OTHERS = "_chunk long, bucket long, size int, n binary, k binary"


def _dealt(chunk: int, items: np.ndarray, n: np.ndarray, k: np.ndarray, buckets: int) -> pa.Table:
    """A chunk's counts as one run for each range of hashes that it has items of."""
    bucket = ((items >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    bounds = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(items)] if len(items) else np.zeros(1, np.int64)
    runs = [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.table({
        "bucket": bucket[bounds[:-1]], "_chunk": np.full(len(runs), chunk), "size": np.diff(bounds).astype(np.int32),
        "items": pa.array([_encoded(np.diff(items[r], prepend=np.uint64(0))) for r in runs], pa.binary()),
        "n": pa.array([_encoded(n[r]) for r in runs], pa.binary()),
        "k": pa.array([_encoded(k[r]) for r in runs], pa.binary())})


def _column(runs: pa.Table, name: str) -> list[np.ndarray]:
    return [_decoded(data.as_py(), size.as_py()) for data, size in zip(runs.column(name), runs.column("size"))]


def _items_of(runs: pa.Table) -> list[np.ndarray]:
    return [np.cumsum(differences) for differences in _column(runs, "items")]


def _others(runs: pa.Table) -> pa.Table:
    """For each run of the range, what the other chunks count of its items."""
    distinct, at = np.unique(np.concatenate(_items_of(runs)), return_inverse=True)
    starts = np.cumsum(runs.column("size").to_numpy())[:-1]
    out = {c: runs.column(c) for c in ("_chunk", "bucket", "size")}
    for name in ("n", "k"):
        own = np.concatenate(_column(runs, name)).astype(np.int64)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, at, own)
        out[name] = pa.array([_encoded(x) for x in np.split(total[at] - own, starts)], pa.binary())
    return pa.table(out)


def _words_of(runs: pa.Table) -> pa.Table:
    items = np.unique(np.concatenate(_items_of(runs)))
    return pa.table({"v": [int((items & np.uint64(1) == 0).sum())]})


def _chunked(docs: DataFrame, limit: int) -> DataFrame:
    """Slices of the rows, their texts compressed together; neighbouring slices of about ``limit`` bytes share ``_chunk``.

    ``_at`` is the number of the slice's first row in its chunk; ``tokens`` and ``lengths`` (bytes) go by row.
    """
    schema = T.StructType([
        T.StructField("_chunk", T.LongType()), T.StructField("_at", T.IntegerType()),
        T.StructField("keys", T.ArrayType(docs.schema["key"].dataType)), T.StructField("tokens", T.ArrayType(T.IntegerType())),
        T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("bytes", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("data", T.BinaryType())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        chunk, held, rows = TaskContext.get().partitionId() << 32, 0, 0
        for batch in slices(batches, 1, min(limit, SLICE_BYTES)):
            data, edges = _flat(batch.column(1))
            # A row counts as some bytes more, so that empty texts fill a chunk too.
            size = 64 * len(batch) + len(data)
            if rows and held + size > limit:
                chunk, held, rows = chunk + 1, 0, 0
            tokens = np.bincount(words(data, edges)[1], minlength=len(batch))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([rows], pa.int32()), pa.ListArray.from_arrays([0, len(batch)], batch.column(0)),
                 pa.array([tokens.astype(np.int32)]), pa.array([np.diff(edges)]), pa.array([len(data)]),
                 pa.array([int(tokens.sum())]), pa.array([pa.compress(data, "zstd", asbytes=True)])], schema.names)
            held, rows = held + size, rows + len(batch)

    return docs.select("key", "_text").mapInArrow(run, schema)


def _chunk_counts(docs: pa.Table, flagged: pa.Table):
    """A chunk's keys, its words' rows, the places of second words, and the item counts as of ``_counts``."""
    docs = docs.sort_by("_at")
    keys = docs.column("keys").combine_chunks().flatten()
    lengths = docs.column("lengths").combine_chunks().flatten().to_numpy()
    data = np.frombuffer(b"".join(pa.decompress(d.as_py(), n.as_py(), "zstd", asbytes=True)
                                  for d, n in zip(docs.column("data"), docs.column("bytes"))), np.uint8)
    target = np.zeros(len(keys), np.int64)
    for rows in flagged.column("rows").to_pylist():
        target[rows or []] = 1
    hashes, owner = words(data, np.r_[0, np.cumsum(lengths)])
    both, second = _pairs(hashes, owner)
    flags = target[owner]
    return keys, owner, second, _counts(np.r_[hashes, both], np.r_[flags, flags[second]])


def scores(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
           chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``key, n_tokens, target_loss, background_loss, score`` of every row; ``target`` holds the target's keys."""
    chunked = stage_table(_chunked(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("_text")), chunk_bytes),
                          "lm-documents", compression="none")
    # Keys alone are joined, by a shuffle at every size: the target's keys grow with the corpus.
    marked = target.select(F.col(key).alias("key"), F.lit(True).alias("in")).distinct().hint("merge")
    each = (chunked.select("_chunk", "_at", F.posexplode(F.arrays_zip("keys", "tokens")).alias("i", "row"))
            .select("_chunk", (F.col("_at") + F.col("i")).alias("row"), F.col("row.keys").alias("key"), "row.tokens"))
    flagged = stage_table(
        each.join(marked, "key", "left").groupBy("_chunk")
        .agg(F.collect_list(F.when(F.col("in"), F.col("row"))).alias("rows"),
             F.sum(F.when(F.col("in"), F.col("tokens"))).alias("tokens")), "lm-target")
    zero = F.lit(0)
    size, n_all = chunked.agg(*(F.coalesce(F.sum(c), zero) for c in ("bytes", "n"))).first()
    n_target = flagged.agg(F.coalesce(F.sum("tokens"), zero)).first()[0]
    buckets = 1 + size // bucket_bytes

    def count(docs: pa.Table, flagged: pa.Table) -> pa.Table:
        *_, (items, _, n, k) = _chunk_counts(docs, flagged)
        return _dealt(docs.column("_chunk")[0].as_py(), items, n, k, buckets)

    targets = flagged.select("_chunk", "rows")
    counted = (chunked.groupBy("_chunk").cogroup(targets.groupBy("_chunk"))
               .applyInArrow(count, RUN).groupBy("bucket"))
    # The distinct words come from the shuffle that the sums come from.
    n_words = counted.applyInArrow(_words_of, "v long").agg(F.coalesce(F.sum("v"), zero).alias("v"))
    known = counted.applyInArrow(_others, OTHERS).unionByName(targets.withColumn("v", n_words.scalar()), allowMissingColumns=True)

    def score(docs: pa.Table, known: pa.Table) -> pa.Table:
        keys, owner, second, (_, at, *counts) = _chunk_counts(docs, known)
        n_words = pa.compute.max(known.column("v")).as_py()
        # The runs in the order of their ranges are the chunk's items in ascending order.
        runs = known.filter(pa.compute.is_valid(known.column("bucket"))).sort_by("bucket")
        counts = [np.add(c, np.concatenate([*_column(runs, name), c[:0]]).astype(np.int64)) for c, name in zip(counts, ("n", "k"))]
        lengths = np.bincount(owner, minlength=len(keys))
        means = []
        for c, size in zip(counts, (n_all, n_target)):
            of_word, of_pair = c[at[:len(owner)]], c[at[len(owner):]]
            p = (of_word + 1) / (size + n_words)
            before = of_word[second - 1]
            # A word never seen leaves all to the unigrams.
            p[second] = np.where(before > 0, BIGRAM * of_pair / np.maximum(before, 1) + (1 - BIGRAM) * p[second], p[second])
            means.append(np.bincount(owner, -np.log(p), len(keys)) / np.maximum(lengths, 1))
        background, aimed = means
        none = lengths == 0
        return pa.Table.from_arrays(
            [keys, pa.array(lengths), *(pa.array(x, mask=none) for x in (aimed, background, aimed - background))],
            ["key", "n_tokens", "target_loss", "background_loss", "score"])

    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
                           *(T.StructField(c, T.DoubleType()) for c in ("target_loss", "background_loss", "score"))])
    return (chunked.groupBy("_chunk").cogroup(known.groupBy("_chunk")).applyInArrow(score, schema)
            .withColumnRenamed("key", key))
