"""AGG5: exact per-group percentiles without gathering a group into one task.

Spark's ``percentile`` / ``percentile_disc`` aggregates hold every distinct
value of a group in one hash map at the final merge, which does not hold for
a group carrying a large share of all rows. Here instead:

1. count rows per (group, value)             - map-side combined
2. range-partition those pairs by (group, value); each partition is a
   contiguous value range, so a hot group is spread over many partitions
   (``_bucket``)
3. sort inside each partition and take the running count per group there
   (vectorized over Arrow batches; no second shuffle); the result is
   staged, fixing the bucket assignment
4. per (bucket, group) totals -> per-group offsets and sizes; this table has
   at most (buckets + groups) rows
5. join it back (size-checked broadcast) and keep the pairs that hold the
   wanted ranks.

Semantics: ``disc`` = smallest value whose cumulative share reaches p
(``percentile_disc``); ``cont`` = linear interpolation between the values at
0-based positions floor((n-1)p) and ceil((n-1)p) (``percentile``).
Rows with a NULL value or NULL group key are ignored.

``binned_percentile`` first counts rows per equal-width bin, so that only the
rows of the bin that holds the rank are ranked this way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from devpulse.operators.joins import join_small
from devpulse.plans.staging import stage_table


def exact_percentile(df: DataFrame, group_cols: list[str], value_col: str, p: float,
                     method: str = "disc", out_col: str = "percentile", buckets: int | None = None,
                     part_of: DataFrame | None = None) -> DataFrame:
    """``part_of``: ``group_cols, _below, _n`` when ``df`` holds only a run of each group's
    ordered rows: how many of the group's ``_n`` rows come before the run."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be in [0, 1]")
    if method not in ("disc", "cont"):
        raise ValueError("method must be 'disc' or 'cont'")
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = list(group_cols)
    v = value_col
    present = F.col(v).isNotNull()
    for c in g:
        present = present & F.col(c).isNotNull()
    pairs = df.filter(present).groupBy(*g, v).agg(F.count(F.lit(1)).alias("_c"))
    ranged = (pairs.repartitionByRange(buckets, *[F.col(c) for c in g], F.col(v))
              .sortWithinPartitions(*g, v))
    schema = T.StructType(ranged.schema.fields + [T.StructField("_bucket", T.IntegerType(), False),
                                                  T.StructField("_run", T.LongType(), False)])
    ranked = stage_table(ranged.mapInArrow(_running_counts(g), schema), "exact-quantile")

    totals = ranked.groupBy("_bucket", *g).agg(F.sum("_c").alias("_tot"))
    before = Window.partitionBy(*g).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*g)
    offsets = totals.select(
        "_bucket", *g,
        F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"),
        F.sum("_tot").over(whole).alias("_n"),
    )
    if part_of is not None:
        offsets = (offsets.drop("_n").join(part_of, g)
                   .select("_bucket", *g, (F.col("_off") + F.col("_below")).alias("_off"), "_n"))
    offsets = stage_table(offsets, "quantile-offsets")
    located = join_small(ranked, offsets, ["_bucket", *g])
    first_rank = F.col("_off") + F.col("_run") - F.col("_c") + 1   # 1-based rank of first copy
    last_rank = F.col("_off") + F.col("_run")

    if method == "disc":
        k = F.greatest(F.ceil(F.lit(p) * F.col("_n")), F.lit(1))
        hit = located.filter((first_rank <= k) & (k <= last_rank))
        return hit.select(*g, F.col(v).cast("double").alias(out_col))

    pos = (F.col("_n") - 1) * F.lit(p)
    lo = F.floor(pos) + 1
    hi = F.ceil(pos) + 1
    marked = located.select(
        *g, F.col(v).cast("double").alias("_v"), (pos - F.floor(pos)).alias("_frac"),
        ((first_rank <= lo) & (lo <= last_rank)).alias("_is_lo"),
        ((first_rank <= hi) & (hi <= last_rank)).alias("_is_hi"),
    ).filter(F.col("_is_lo") | F.col("_is_hi"))
    agg = marked.groupBy(*g).agg(
        F.max(F.when(F.col("_is_lo"), F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_is_hi"), F.col("_v"))).alias("_hi"),
        F.max("_frac").alias("_frac"),
    )
    return agg.select(*g, (F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo"))).alias(out_col))


def target_bins(bins: DataFrame, group_cols: list[str], p: float, method: str = "disc") -> DataFrame:
    """``group_cols, _lo_bin, _hi_bin, _below, _n``: the bins that hold the wanted ranks (one bin, or two
    neighbours for ``cont``) and the rows below them, from ``group_cols, _bin, _rows``."""
    order = Window.partitionBy(*group_cols).orderBy("_bin")
    whole = Window.partitionBy(*group_cols)
    counted = bins.select(*group_cols, "_bin", "_rows", F.sum("_rows").over(order).alias("_upto"),
                          F.sum("_rows").over(whole).alias("_n"))
    if method == "disc":
        lo = hi = F.greatest(F.ceil(F.lit(p) * F.col("_n")), F.lit(1))
    else:
        pos = (F.col("_n") - 1) * F.lit(p)
        lo, hi = F.floor(pos) + 1, F.ceil(pos) + 1
    return counted.groupBy(*group_cols).agg(
        F.min(F.when(F.col("_upto") >= lo, F.col("_bin"))).alias("_lo_bin"),
        F.min(F.when(F.col("_upto") >= hi, F.col("_bin"))).alias("_hi_bin"),
        F.min(F.when(F.col("_upto") >= lo, F.col("_upto") - F.col("_rows"))).alias("_below"),
        F.max("_n").alias("_n"),
    )


def binned_percentile(df: DataFrame, bins: DataFrame, group_cols: list[str], value_col: str, bin_col: str, p: float,
                      method: str = "disc", out_col: str = "percentile") -> DataFrame:
    """``exact_percentile`` where only the bins that hold the wanted ranks are ranked.

    ``bin_col`` of ``df`` must rise with the value inside a group, and ``bins`` (materialized) must hold
    the rows per ``group_cols, _bin``. A bin may hold any number of rows: they are ranked as above.
    """
    targets = stage_table(target_bins(bins, group_cols, p, method), "target-bins")
    chosen = (join_small(df, targets.select(*group_cols, "_lo_bin", "_hi_bin"), group_cols)
              .filter(F.col(bin_col).between(F.col("_lo_bin"), F.col("_hi_bin"))))
    return exact_percentile(chosen, group_cols, value_col, p, method, out_col,
                            part_of=targets.select(*group_cols, "_below", "_n"))


def _running_counts(group_cols: list[str]):
    """Arrow batches of one range partition, sorted by (group, value) ->
    the same rows plus ``_bucket`` (the partition) and ``_run`` (running sum
    of ``_c`` inside the group, carried across batches)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext

    def run(batches):
        bucket = TaskContext.get().partitionId()
        last_key, carry = None, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            counts = batch.column("_c").to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.zeros(n, dtype=bool)
            starts[0] = True
            for c in group_cols:
                col = batch.column(c)
                if n > 1:
                    changed = pc.not_equal(col.slice(1), col.slice(0, n - 1))
                    starts[1:] |= changed.to_numpy(zero_copy_only=False)
            total = np.cumsum(counts)
            seg = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
            running = total - (total[seg] - counts[seg])
            first_key = tuple(batch.column(c)[0].as_py() for c in group_cols)
            if first_key == last_key:
                running[seg == 0] += carry
            last_key = tuple(batch.column(c)[n - 1].as_py() for c in group_cols)
            carry = int(running[-1])
            yield (batch.append_column("_bucket", pa.array(np.full(n, bucket, dtype=np.int32)))
                   .append_column("_run", pa.array(running, type=pa.int64())))
    return run
