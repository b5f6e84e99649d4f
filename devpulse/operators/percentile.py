"""Daily percentile report operators (AGG3-AGG6, FLT9, FLT10, JOIN1, JOIN2, SRT1, LIM1).

Group keys are (device_type, event_date): few groups, each potentially huge.
Every aggregate here is partial-aggregation friendly (avg, stddev, count,
exact distinct via two-level aggregation, and the percentile sketch), so the
shuffles move per-task partial states, never the rows of a hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from devpulse import constants as C
from devpulse.operators.exact_quantile import binned_percentile
from devpulse.operators.joins import MAX_BROADCAST_ROWS, DEFAULT_SALTS, join_small
from devpulse.operators.sketch_quantile import DEALS, SKETCH_K, two_level_quantile
from devpulse.plans.staging import stage_table

# Equal parts of a group's kept range; the percentile's second pass reads the rows of one.
BINS = 1024
GROUP_KEYS = ["device_type", "event_date"]


def population_column(population: str) -> str:
    """TRAP5: the gate counts distinct devices (behaviour) or events (spec)."""
    if population == "devices":
        return "device_id"
    if population == "events":
        return "event_id"
    raise ValueError("population must be 'devices' or 'events'")


def daily_stats(df: DataFrame, population: str = "devices") -> DataFrame:
    """AGG3: per (type, day) mean, sample stddev and distinct population."""
    return df.groupBy(*GROUP_KEYS).agg(
        F.avg("event_duration").alias("daily_mean"),
        F.stddev_samp("event_duration").alias("daily_stddev"),
        F.countDistinct(population_column(population)).alias("distinct_events"),
    )


def min_population(stats: DataFrame, n: int = C.MIN_POPULATION) -> DataFrame:
    """FLT10: groups whose distinct population reaches ``n`` (HAVING)."""
    return stats.filter(F.col("distinct_events") >= F.lit(n))


def attach_group_stats(events: DataFrame, stats: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                       salts: int = DEFAULT_SALTS) -> DataFrame:
    """JOIN1: many-to-one inner join of events to their group's statistics.

    The statistics side has one row per (type, day); it is broadcast after its
    size is checked, so the event side is never shuffled.
    """
    return join_small(events, stats, GROUP_KEYS, "inner", max_broadcast_rows, salts)


def restrict_to_groups(events: DataFrame, groups: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                       salts: int = DEFAULT_SALTS) -> DataFrame:
    """JOIN2: keep events of the listed groups (semi-join; no duplication)."""
    return join_small(events, groups.select(*GROUP_KEYS), GROUP_KEYS, "left_semi", max_broadcast_rows, salts)


def within_sigma(df: DataFrame, k: float = C.OUTLIER_STD_DEVIATIONS) -> DataFrame:
    """FLT9: |x - mean| <= k * stddev (inclusive; NULL stddev drops the row)."""
    return df.filter(F.abs(F.col("event_duration") - F.col("daily_mean")) <= F.lit(k) * F.col("daily_stddev"))


def daily_percentile(df: DataFrame, p: float = C.PERCENTILE, accuracy: int = C.PERCENTILE_ACCURACY) -> DataFrame:
    """AGG4: report measures per (type, day) over the kept rows.

    Two aggregates joined on the (small) group keys:
    * sketch, mean, stddev and count per (type, day): each map task ships one
      partial row per group; ``percentile_approx`` is a mergeable sketch whose
      size is set by ``accuracy``, not by the group's row count;
    * exact distinct devices: a keys-only two-level aggregate.
    In one aggregate Spark would key the partial state by (type, day, device)
    because of the distinct count, shipping a sketch (i.e. the raw values) per
    device and task. One task merges all sketches of a group: for groups read
    by very many map tasks take ``daily_percentile_sketch``.
    """
    measures = df.groupBy(*GROUP_KEYS).agg(
        F.percentile_approx("event_duration", p, accuracy).alias("percentile_95"),
        F.avg("event_duration").alias("mean_duration"),
        F.stddev_samp("event_duration").alias("stddev_duration"),
        F.count(F.lit(1)).alias("total_events"),
    )
    devices = df.groupBy(*GROUP_KEYS).agg(F.countDistinct("device_id").alias("distinct_devices"))
    return measures.join(devices, GROUP_KEYS, "inner").select(*C.REPORT_COLUMNS)


def daily_percentile_sketch(df: DataFrame, p: float = C.PERCENTILE, k: int = SKETCH_K, deals: int = DEALS) -> DataFrame:
    """AGG4 without a hot reducer: the report measures per (type, day), sketches merged on two levels.

    Exact percentiles for groups of at most ``k`` rows; beyond, see ``rank_error``. Distinct devices are
    a keys-only aggregate of their own, as in ``daily_percentile``.
    """
    found = two_level_quantile(df, GROUP_KEYS, "event_duration", p, "percentile_95", k, deals)
    measures = found.withColumnsRenamed({"_mean": "mean_duration", "_stddev": "stddev_duration", "_rows": "total_events"})
    devices = df.groupBy(*GROUP_KEYS).agg(F.countDistinct("device_id").alias("distinct_devices"))
    return measures.join(devices, GROUP_KEYS, "inner").select(*C.REPORT_COLUMNS)


def with_bin(df: DataFrame, k: float = C.OUTLIER_STD_DEVIATIONS, bins: int = BINS) -> DataFrame:
    """``_bin``: which of ``bins`` equal parts of [mean - k sd, mean + k sd] holds the duration.

    It rises with the duration inside a group; values beyond the ends fall in the outer bins.
    """
    low = F.col("daily_mean") - F.lit(k) * F.col("daily_stddev")
    part = (F.col("event_duration") - low) / (F.lit(2 * k) * F.col("daily_stddev"))
    at = F.least(F.greatest(F.floor(part * F.lit(bins)), F.lit(0)), F.lit(bins - 1)).cast("int")
    return df.withColumn("_bin", F.when(F.col("daily_stddev") > 0, at).otherwise(0))


def daily_profile(binned: DataFrame) -> DataFrame:
    """Per (type, day, bin) rows, mean and squared deviations, and per (type, day) distinct devices
    (the row whose bin is NULL), in one pass over the rows.

    Every state has a fixed width, so map tasks ship at most one small row for each bin and device.
    """
    devices = F.grouping("device_id") == 0
    parts = (binned.groupingSets([[*GROUP_KEYS, "_bin"], [*GROUP_KEYS, "device_id"]], *GROUP_KEYS, "_bin", "device_id")
             .agg(devices.alias("_is_device"), F.count(F.lit(1)).alias("_rows"),
                  F.avg("event_duration").alias("_mean"), F.var_pop("event_duration").alias("_var")))
    return parts.groupBy(*GROUP_KEYS, "_bin").agg(
        F.sum(F.when(~F.col("_is_device"), F.col("_rows"))).alias("_rows"),
        F.max(F.when(~F.col("_is_device"), F.col("_mean"))).alias("_mean"),
        F.max(F.when(~F.col("_is_device"), F.col("_var") * F.col("_rows"))).alias("_m2"),
        F.count(F.when(F.col("_is_device"), F.col("device_id"))).alias("_devices"),
    )


def daily_percentile_exact(df: DataFrame, p: float = C.PERCENTILE, method: str = "disc",
                           k: float = C.OUTLIER_STD_DEVIATIONS, bins: int = BINS) -> DataFrame:
    """AGG4/AGG5: report measures per (type, day) over the kept rows, the percentile exact (``disc`` or ``cont``).

    One pass over the rows (``daily_profile``, staged) gives every measure but the percentile; it also
    names the bin that holds the rank, and a second pass ranks that bin's rows only. No task holds or
    merges anything that grows with a group's rows.
    """
    binned = with_bin(df, k, bins)
    profile = stage_table(daily_profile(binned), "daily-profile")
    whole = profile.groupBy(*GROUP_KEYS).agg(
        F.sum("_rows").alias("total_events"), F.max("_devices").alias("distinct_devices"),
        (F.sum(F.col("_rows") * F.col("_mean")) / F.sum("_rows")).alias("mean_duration"))
    spread = (profile.join(whole, GROUP_KEYS).groupBy(*GROUP_KEYS, "total_events", "distinct_devices", "mean_duration")
              .agg(F.sum(F.col("_m2") + F.col("_rows") * F.pow(F.col("_mean") - F.col("mean_duration"), 2)).alias("_m2")))
    measures = spread.withColumn("stddev_duration", F.when(
        F.col("total_events") > 1, F.sqrt(F.col("_m2") / (F.col("total_events") - 1))))
    exact = binned_percentile(binned, profile.filter(F.col("_bin").isNotNull()), GROUP_KEYS, "event_duration", "_bin",
                              p, method, "percentile_95")
    return exact.join(measures, GROUP_KEYS).select(*C.REPORT_COLUMNS)


def report_summary(report: DataFrame) -> DataFrame:
    """AGG6: one row: groups, avg p95, avg mean, avg events per group."""
    return report.agg(
        F.count(F.lit(1)).alias("total_device_type_days"),
        F.avg("percentile_95").alias("avg_percentile_95"),
        F.avg("mean_duration").alias("avg_mean_duration"),
        F.avg("total_events").alias("avg_events_per_day"),
    )


def order_report(report: DataFrame) -> DataFrame:
    """SRT1: by device_type, event_date ascending."""
    return report.orderBy(*GROUP_KEYS)


def top_rows(report: DataFrame, n: int = 10) -> DataFrame:
    """LIM1: the first ``n`` rows of the ordered report (top-k, not a sample)."""
    return order_report(report).limit(n)
