"""Approximate quantiles of huge groups by a sketch that is merged on two levels (AGG4).

``percentile_approx`` merges the partial states of a group, one a map task, in
one task. Spark's KLL sketches are ordinary binary values, so a group can be
merged in parts: first by (group, deal), where a map task belongs to one of
``deals`` deals, then the deals' sketches by group. A task of the first level
merges one state for each map task of its deal, one of the second at most
``deals``. All states have a bounded width, whatever the group's rows.

A group of at most ``k`` rows is kept whole: its quantile is exact (the smallest
value whose share of rows is at least p, as SQL's ``percentile_disc``). Beyond,
the share differs from p by about 2.3 / k^0.9 at most, with a confidence of
99 %; which value is taken then depends on the sketch's random choices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_K = 8192
DEALS = 256


def rank_error(k: int) -> float:
    """What the share of rows at or below the answer may differ from p (99 % confidence)."""
    return 2.296 / k**0.9021


def two_level_quantile(df: DataFrame, keys: list[str], value: str, p: float, name: str, k: int = SKETCH_K,
                       deals: int = DEALS, deal: Column | None = None) -> DataFrame:
    """``keys``, the quantile as ``name``, and ``_rows, _mean, _stddev`` of the non-NULL values of a group."""
    deal = F.pmod(F.spark_partition_id(), F.lit(deals)) if deal is None else deal
    known = df.select(*keys, F.col(value).cast("double").alias("_v"), deal.alias("_deal")).where("_v IS NOT NULL")
    parts = known.groupBy(*keys, "_deal").agg(
        F.kll_sketch_agg_double("_v", k).alias("_sketch"), F.count(F.lit(1)).alias("_n"), F.avg("_v").alias("_m"),
        F.var_pop("_v").alias("_var"))
    group = Window.partitionBy(*keys)
    # Squared deviations of the parts add up around the whole mean.
    parts = parts.withColumn("_mean", F.sum(F.col("_n") * F.col("_m")).over(group) / F.sum("_n").over(group))
    squares = F.sum(F.col("_n") * (F.col("_var") + F.pow(F.col("_m") - F.col("_mean"), 2)))
    whole = parts.groupBy(*keys, "_mean").agg(
        F.kll_merge_agg_double("_sketch", k).alias("_sketch"), F.sum("_n").alias("_rows"), squares.alias("_m2"))
    return whole.select(*keys, F.kll_sketch_get_quantile_double("_sketch", F.lit(p)).alias(name), "_rows", "_mean",
                        F.when(F.col("_rows") > 1, F.sqrt(F.col("_m2") / (F.col("_rows") - 1))).alias("_stddev"))
