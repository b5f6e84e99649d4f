"""Batch writers for the report (SNK3, SNK4) and the window table.

Streaming writers live in ``devpulse.streaming.sinks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DEFAULT_PARTITIONS = ("device_type", "event_date")


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """SNK3/SNK4: ``csv`` -> one header CSV file (the report is one row per
    type and day, so a single writer task is bounded); anything else ->
    Parquet, not coalesced. Both overwrite."""
    if fmt.lower() == "csv":
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def with_partition_date(df: DataFrame) -> DataFrame:
    """Add ``event_date`` (day of ``window_start``) for day-level directories."""
    return df.withColumn("event_date", F.to_date("window_start"))


def write_windows(df: DataFrame, path: str, partition_by=DEFAULT_PARTITIONS, mode: str = "append") -> None:
    """Batch write of the window table, partitioned.

    ``rebalance`` lets AQE size the output files: small directories are
    combined and a hot (type, day) is split over several tasks instead of one.
    """
    if "event_date" in partition_by and "event_date" not in df.columns:
        df = with_partition_date(df)
    (df.hint("rebalance", *partition_by).write.mode(mode)
     .partitionBy(*partition_by).parquet(path))
