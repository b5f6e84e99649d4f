"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up the rank of
every neighbouring pair by binary search over the sorted pair keys
(``left * size + right``), takes each word's lowest rank and merges all its
occurrences, left to right; words without a known pair leave the batch. Only
distinct words are encoded: a Python worker keeps a bounded table, which
changes speed, never results.

Everything is a map over the rows: no shuffle, no driver work, and a lost
executor costs only its own tasks.

Defined results: a null or empty text has no ids (``ids`` empty, not null)
and decodes to the empty text; null ids decode to null. Special strings
inside a text become their special ids. Repeated rows give repeated results,
other columns are not touched (and not read beyond the key).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.llm.batches import slices
from devpulse.llm.wordbpe import END, split_normal, vocabulary

#: Words kept by a Python worker.
TABLE_WORDS = 600_000
NONE = np.iinfo(np.int64).max


class MergeTable:
    """The merges of a vocabulary as sorted pair keys."""

    def __init__(self, path: str):
        self.vocabulary = v = vocabulary(path)
        self.size = len(v.tokens)
        self.first = np.array([v.ids[c] for c in v.letters], np.int64)
        self.last = np.array([v.ids[c + END] for c in v.letters], np.int64)
        left = np.array([v.ids[a] for a, _ in v.merges], np.int64)
        right = np.array([v.ids[b] for _, b in v.merges], np.int64)
        made = np.array([v.ids[a + b] for a, b in v.merges], np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")

    def _lookup(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pairs that begin at the places ``at`` (rank NONE: no such merge)."""
        then = np.minimum(at + 1, len(symbols) - 1)
        pair = symbols[at] * self.size + symbols[then]
        found = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        known = (self.keys[found] == pair) & (owner[at] == owner[then]) & (at < then)
        return np.where(known, self.ranks[found], NONE), self.made[found]

    def encode_words(self, words: Sequence[str]) -> list[bytes]:
        """The ids of each (normalised, non-empty) word, packed as ``dtype``."""
        if not words:
            return []
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.first[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(raw)), lengths)
        rank, made = self._lookup(symbols, owner, np.arange(len(symbols)))
        done_symbols, done_owner = [], []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            lowest = np.repeat(lowest, np.diff(np.r_[starts, len(symbols)]))
            over = lowest == NONE
            hits = np.flatnonzero((rank == lowest) & ~over)
            if len(hits) > 1 and (np.diff(hits) == 1).any():  # a run of one symbol: every other pair
                new = np.r_[True, np.diff(hits) != 1]
                count = np.arange(len(hits))
                hits = hits[(count - np.maximum.accumulate(np.where(new, count, 0))) % 2 == 0]
            symbols[hits] = made[hits]
            keep = ~over
            keep[hits + 1] = False
            done_symbols.append(symbols[over])
            done_owner.append(owner[over])
            merged = (np.cumsum(keep) - 1)[hits]
            symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
            touched = np.concatenate([merged, merged[merged > 0] - 1])
            rank[touched], made[touched] = self._lookup(symbols, owner, touched)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        packed = symbols[order].astype(self.dtype).tobytes()
        bounds = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(raw)))] * self.dtype.itemsize
        bounds = bounds.tolist()
        return [packed[a:b] for a, b in zip(bounds, bounds[1:])]


class Encoder:
    """Texts to ids with a bounded table of words.

    The chunks between white space are numbered by Arrow's dictionaries, so that Python only sees the distinct ones
    of a call; the ids of all chunks are then gathered by their numbers.
    """

    def __init__(self, path: str):
        self.table = MergeTable(path)
        #: What every table begins with: the empty chunk and the special strings.
        self.fixed = {"": b""} | {s: np.array([i], self.table.dtype).tobytes()
                                  for s, i in self.table.vocabulary.stand_ins.items()}
        self.words: dict[str, bytes] = self.fixed.copy()

    def _ids(self, chunks: Sequence[str]) -> list[bytes]:
        """The ids of each chunk, packed; each distinct new word among them is encoded once."""
        ids = list(map(self.words.get, chunks))
        left = [i for i, found in enumerate(ids) if found is None]
        # Most are letters with symbols after them, which needs no pattern.
        heads = [chunks[i].rstrip(punctuation) for i in left]
        tails = [chunks[i][len(head):] for i, head in zip(left, heads)]
        mixed = {i: split_normal(chunks[i]) for i, head in zip(left, heads) if not head.isalpha()}
        every = set(filter(str.isalpha, heads)).union(tails, *mixed.values())
        new = list(every.difference(self.words))
        if len(self.words) + len(new) > TABLE_WORDS:
            self.words = self.fixed.copy()
            new = list(every.difference(self.words))
        self.words.update(zip(new, self.table.encode_words(new)))
        get = self.words.__getitem__
        for i, head, tail in zip(left, heads, tails):
            ids[i] = b"".join(map(get, mixed[i])) if i in mixed else get(head) + get(tail)
        return ids

    def encode(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text as an unsigned array."""
        spaced = self.table.vocabulary.spaced
        chunks = pc.ascii_split_whitespace(pa.array([spaced(t) if t else "" for t in texts], pa.large_string()))
        coded = chunks.values.dictionary_encode()
        index = coded.indices.to_numpy()
        ids = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.table.dtype.itemsize
        first = np.cumsum(lengths) - lengths
        n = lengths[index]
        ends = np.cumsum(n)
        at = np.repeat(first[index] - ends + n, n)
        at += np.arange(len(at))
        out = np.frombuffer(b"".join(ids), self.table.dtype)[at]
        bounds = np.r_[0, ends][chunks.offsets.to_numpy()].tolist()
        for a, b in zip(bounds, bounds[1:]):
            yield out[a:b]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, n_tokens``: ``ids`` are little-endian unsigned 32-bit integers."""
    kind = df.schema[key].dataType

    def run(batches):
        enc = encoder(path)
        for batch in slices(batches, 1):
            ids = [i.astype("<u4").tobytes() for i in enc.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())],
                ["key", "ids", "n_tokens"])

    schema = T.StructType([T.StructField("key", kind), T.StructField("ids", T.BinaryType()),
                           T.StructField("n_tokens", T.LongType())])
    return (df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, schema).withColumnRenamed("key", key))


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids", also: Sequence[str] = ()) -> DataFrame:
    """``key, decoded`` and the columns ``also``: the tokens of the ids joined by spaces (the file names no decoder)."""

    def run(batches):
        tokens = vocabulary(path).tokens
        get = tokens.__getitem__
        for batch in slices(batches, 1):
            out = [None if i is None else " ".join(map(get, np.frombuffer(i, "<u4").tolist()))
                   for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.string()), *batch.columns[2:]],
                ["key", "decoded", *batch.schema.names[2:]])

    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("decoded", T.StringType()),
                           *(df.schema[c] for c in also)])
    return (df.select(F.col(key).alias("key"), F.col(ids).alias("ids"), *also)
            .mapInArrow(run, schema).withColumnRenamed("key", key))


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of a round trip through ids."""
    coded = encode(df, path, key, text).withColumn("ids_sha256", _sha("ids"))
    return (decode(coded, path, key, also=("n_tokens", "ids_sha256"))
            .select(key, "n_tokens", "ids_sha256", _sha("decoded").alias("decoded_sha256")))


def _sha(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)
