"""Packing of tokenised documents into fixed-length sequences by column generation.

1. One map over the documents encodes them, appends the end id, cuts every
   document into full sequences and one rest, and records each piece with its
   checksum. The piece table (a few numbers a piece, no text) is staged.
2. The histogram of piece lengths in classes of ``step`` tokens (at most
   ``capacity / step`` rows, whatever the corpus size) goes to the driver. A
   linear program over packing patterns finds how often each pattern is used;
   new patterns are priced by an unbounded-knapsack dynamic program and enter
   until a lower bound is within ``gap``. Counts are rounded
   down; what is left over is packed by first fit over the histogram.
3. The pieces of a length class are ranked (row numbers inside hashed
   sub-groups plus the sub-groups' running counts, so that no class has to fit
   one task), and rank ranges are mapped to pattern instances. Offsets are
   running sums within a sequence (at most ``capacity`` pieces).

Cutting happens only at full sequences: a rest is never cut. A sequence's
padding is what its pieces leave of ``capacity``; a sequence whose length is a
power of two needs none. Lengths are rounded up to ``step`` tokens up to a
quarter of the capacity, to twice that up to a half, then to four times that:
about half a step of padding for each short piece.

Defined results: a null or empty text is the end id alone (one piece of
length 1); repeated rows are packed each, also rows of one key with different
texts (ranks follow the checksums, so a task run again gives the same rows);
an empty table gives no rows; null
keys are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.llm.batches import slices
from devpulse.llm.bpe import encoder
from devpulse.plans.staging import stage_table

CAPACITY = 4096
STEP = 8
GAP = 2e-3
#: Columns that enter after one run of the dynamic program, at most, and runs at most.
COLUMNS = 12
ROUNDS = 1500
#: Share of the best bound's prices in the prices that patterns are sought at.
SMOOTH = 0.7


def pieces(df: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens``: full sequences and the rest of every document."""

    def run(batches):
        enc = encoder(path)
        end = np.array([end_id], "<u4")
        for batch in slices(batches, 1):
            rows, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(enc.encode(batch.column(1).to_pylist())):
                ids = np.concatenate([ids.astype("<u4"), end])
                for a in range(0, len(ids), capacity):
                    part = ids[a:a + capacity]
                    rows.append(i)
                    start.append(a)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int32())), *(pa.array(x, pa.int64())
                                                                     for x in (start, length, crc, total))],
                ["key", "start", "length", "ids_crc32", "doc_tokens"])

    schema = T.StructType([T.StructField("key", df.schema[key].dataType),
                           *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens"))])
    return (df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, schema).withColumnRenamed("key", key))


def _knapsack(widths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, list[np.ndarray]]:
    """Best value of a pattern, and for the best first pieces the best pattern holding each (widths ascending)."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        n = int(np.searchsorted(widths, c, side="right"))
        if n:
            gain = best[c - widths[:n]] + value[:n]
            i = int(gain.argmax())
            if gain[i] > best[c] + 1e-12:
                best[c], take[c] = gain[i], i
    patterns = []
    for first in np.argsort(-(value + best[capacity - widths]), kind="stable")[:COLUMNS]:
        held, c = np.zeros(len(widths)), capacity - int(widths[first])
        held[first] = 1
        while c:
            if take[c] < 0:
                c -= 1
            else:
                held[take[c]] += 1
                c -= widths[take[c]]
        patterns.append(held)
    return float(best[capacity]), patterns


def _first_fit(widths: np.ndarray, need: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used: widest first, each pattern as often as its pieces allow."""
    left, plan = need.copy(), []
    while left.any():
        held, room = np.zeros_like(left), capacity
        for i in np.flatnonzero(left)[::-1]:
            held[i] = min(left[i], room // widths[i])
            room -= held[i] * widths[i]
        inside = held > 0
        times = int((left[inside] // held[inside]).min())
        left -= held * times
        plan.append((held, times))
    return plan


class _Basis:
    """Patterns of a basic solution, how often each is used, and the inverse of their matrix."""

    def __init__(self, widths: np.ndarray, need: np.ndarray, capacity: int):
        self.columns = np.diag(capacity // widths).astype(float)  # at first patterns of one width
        self.inverse = np.diag(1 / (capacity // widths))
        self.used = self.inverse @ need

    def prices(self) -> np.ndarray:
        return np.maximum(self.inverse.sum(0), 0)

    def enter(self, held: np.ndarray) -> bool:
        """Take in a pattern whose pieces are worth more than a sequence, by the ratio test."""
        if self.inverse.sum(0) @ held <= 1 + 1e-9:
            return False
        step = self.inverse @ held
        ratio = np.full(len(step), np.inf)
        np.divide(self.used, step, out=ratio, where=step > 1e-9)
        out = int(ratio.argmin())
        self.columns[:, out] = held
        self.used -= ratio[out] * step
        self.used[out] = ratio[out]
        np.maximum(self.used, 0, out=self.used)
        row = self.inverse[out] / step[out]
        step[out] = 0
        self.inverse -= np.outer(step, row)
        self.inverse[out] = row
        return True


def cutting_stock(demand: Mapping[int, int], capacity: int, gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """Patterns (width -> pieces) and how often each is used; every demand is covered exactly once.

    ``demand`` maps widths (1 to ``capacity``) to numbers of pieces. First-fit patterns enter the basis first.
    Pricing uses a mean of the prices of the best bound and the current ones, which keeps it from jumping; the
    bound is the best seen. After ``ROUNDS`` rounds the basis is taken as it is.
    """
    widths = np.array(sorted(w for w, n in demand.items() if n), np.int64)
    if not len(widths):
        return []
    need = np.array([demand[w] for w in widths.tolist()], np.int64)
    basis = _Basis(widths, need.astype(float), capacity)
    fitted = _first_fit(widths, need, capacity)
    for held, _ in fitted:
        basis.enter(held.astype(float))
    bound, centre = need @ widths / capacity, basis.prices()  # the bound by the room needed
    pull = SMOOTH
    for _ in range(ROUNDS):
        if basis.used.sum() - bound <= gap * basis.used.sum() + 1e-9:
            break
        prices = pull * centre + (1 - pull) * basis.prices()
        best, patterns = _knapsack(widths, prices, capacity)
        if prices @ need / best > bound:  # prices over the best pattern's value are feasible for the dual
            bound, centre = prices @ need / best, prices / best
        if any([basis.enter(p) for p in patterns]):
            pull = SMOOTH
        elif pull:  # nothing to gain at the mean: price at the current prices
            pull = 0.0
        else:
            break
    left, plan = need.copy(), []
    for j in np.argsort(-basis.used, kind="stable"):
        held = basis.columns[:, j].astype(np.int64)
        inside = held > 0
        times = min(int(basis.used[j] + 1e-6), int((left[inside] // held[inside]).min()))
        if times > 0:
            left -= held * times
            plan.append((held, times))
    plan += _first_fit(widths, left, capacity)
    if sum(n for _, n in fitted) < sum(n for _, n in plan):  # few pieces: rounding may cost more than it gained
        plan = fitted
    return [({int(widths[i]): int(h[i]) for i in np.flatnonzero(h)}, n) for h, n in plan]


def width_class(length: Column, capacity: int, step: int) -> Column:
    """The length rounded up to its class, in steps."""
    def up(n: int) -> Column:
        return F.ceil(length / (n * step)).cast("long") * n

    return F.when(length <= capacity // 4, up(1)).when(length <= capacity // 2, up(2)).otherwise(up(4))


def _places(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each width its pattern uses in rank order: from which rank, which sequences, which slots."""
    rows, ranks, base = [], {}, 0
    for held, times in plan:
        slot = 0
        for width in sorted(held, reverse=True):
            first = ranks.get(width, 0)
            rows.append((width, first, held[width], base, slot))
            ranks[width] = first + held[width] * times
            slot += held[width]
        base += times
    rows.sort()
    return dict(zip(("width", "rank", "held", "base", "slot"), np.array(rows, np.int64).reshape(-1, 5).T))


def pack(df: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, step: int = STEP, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens, sequence_id, offset``, a row for each piece."""
    cut = stage_table(pieces(df, path, end_id, capacity, key, text).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    subs = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = (cut.withColumn("_width", width_class(F.col("length"), capacity, step))
           .withColumn("_sub", F.pmod(F.xxhash64(key, "start", "ids_crc32", "_row"), F.lit(subs))))
    counts = stage_table(cut.groupBy("_width", "_sub").count(), "piece-counts")
    demand = {r["_width"]: r["n"] for r in counts.groupBy("_width").agg(F.sum("count").alias("n")).collect()}
    places = _places(cutting_stock(demand, capacity // step))

    before = Window.partitionBy("_width").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_width", "_sub", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_width", "_sub").orderBy(F.desc("length"), key, "start", "ids_crc32", "doc_tokens", "_row")
    ranked = (cut.withColumn("_rank", F.row_number().over(inside) - 1)
              .join(starts, ["_width", "_sub"]).withColumn("_rank", F.col("_rank") + F.col("_first")))

    def assign(batches):
        span = 1 << 44
        lower = places["width"] * span + places["rank"]
        for batch in batches:
            width, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in (5, 6))
            at = np.searchsorted(lower, width * span + rank, side="right") - 1
            turn = rank - places["rank"][at]
            held = places["held"][at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(places["base"][at] + turn // held),
                 pa.array(places["slot"][at] + turn % held)],
                ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "_slot"])

    schema = T.StructType([T.StructField("key", df.schema[key].dataType), *(
        T.StructField(c, T.LongType())
        for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "_slot"))])
    placed = (ranked.select(F.col(key).alias("key"), "start", "length", "ids_crc32", "doc_tokens", "_width",
                            F.col("_rank").cast("long").alias("_rank"))
              .mapInArrow(assign, schema))
    earlier = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
            .drop("_slot").withColumnRenamed("key", key))
