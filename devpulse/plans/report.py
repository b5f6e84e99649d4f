"""The daily percentile report (flagship plan).

raw or aggregated events -> PRJ5/PRJ6 -> FLT8 -> AGG3 (staged) ->
FLT10 on the statistics -> JOIN1 (broadcast, size-checked; also does
JOIN2's restriction) -> FLT9 -> AGG4 -> SRT1.

Physical shape: the event table is scanned three times (statistics, then the
report's measures and its distinct devices; with an exact method, the counts
per bin and device and the rows of the bin that holds the rank) and never
shuffled row-by-row; the shuffles carry partial aggregates keyed by
(type, day), (type, day, device) or (type, day, bin), and with an exact method
the target bin's (type, day, value) counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from devpulse import constants as C
from devpulse.operators import percentile as PCT
from devpulse.operators.joins import MAX_BROADCAST_ROWS, DEFAULT_SALTS
from devpulse.operators.transform import positive_events, prepare_events, with_event_date
from devpulse.plans.staging import stage_table


def report_input(df: DataFrame, mode: str = "auto") -> DataFrame:
    """PRJ5 -> PRJ6 -> FLT8."""
    return positive_events(with_event_date(prepare_events(df, mode)))


def percentile_report(df: DataFrame, p: float = C.PERCENTILE, k: float = C.OUTLIER_STD_DEVIATIONS,
                      min_population: int = C.MIN_POPULATION, population: str = "devices",
                      accuracy: int = C.PERCENTILE_ACCURACY, mode: str = "auto",
                      stage_stats: bool = True, max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                      salts: int = DEFAULT_SALTS, method: str = "sketch") -> DataFrame:
    """Daily p-th percentile of event_duration per device type, after removing
    rows beyond ``k`` sample standard deviations from the day's mean, over the
    (type, day) groups whose distinct population before outlier removal is at
    least ``min_population``. Ordered by device_type, event_date.

    ``method``: ``sketch`` (the default: KLL sketches merged on two levels,
    exact up to 8,192 rows a group, no task merges one state a map task),
    ``approx`` (``percentile_approx`` with ``accuracy``; one task merges a
    group's sketches), ``disc`` or ``cont`` (exact, AGG5; no task merges more
    than fixed-size rows per bin and map task)."""
    if method not in ("sketch", "approx", "disc", "cont"):
        raise ValueError("method must be 'sketch', 'approx', 'disc' or 'cont'")
    events = report_input(df, mode)
    stats = PCT.daily_stats(events, population)
    if stage_stats:
        stats = stage_table(stats, "daily-stats")
    # Gate and the NULL-stddev case decided on the small side, so one join
    # both attaches the statistics and restricts to qualifying groups.
    qualifying = PCT.min_population(stats, min_population).filter(F.col("daily_stddev").isNotNull())
    kept = PCT.within_sigma(PCT.attach_group_stats(events, qualifying, max_broadcast_rows, salts), k)
    if method == "sketch":
        return PCT.order_report(PCT.daily_percentile_sketch(kept, p))
    if method == "approx":
        return PCT.order_report(PCT.daily_percentile(kept, p, accuracy))
    return PCT.order_report(PCT.daily_percentile_exact(kept, p, method, k))


def percentile_report_two_joins(df: DataFrame, p: float = C.PERCENTILE, k: float = C.OUTLIER_STD_DEVIATIONS,
                                min_population: int = C.MIN_POPULATION, population: str = "devices",
                                accuracy: int = C.PERCENTILE_ACCURACY, mode: str = "auto") -> DataFrame:
    """The same report with the outlier join (JOIN1) and the group restriction
    (JOIN2) as separate joins; kept to show both forms agree."""
    events = report_input(df, mode)
    stats = stage_table(PCT.daily_stats(events, population), "daily-stats")
    kept = PCT.within_sigma(PCT.attach_group_stats(events, stats), k)
    kept = PCT.restrict_to_groups(kept, PCT.min_population(stats, min_population))
    return PCT.order_report(PCT.daily_percentile(kept, p, accuracy))
