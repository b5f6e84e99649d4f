"""Streaming sinks (SNK1, SNK2) and triggers (STR6, STR7, STR8).

Every sink has its own checkpoint folder; a restarted query resumes from it
(offsets and state), so files are neither lost nor written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from devpulse import constants as C
from devpulse.sinks import with_partition_date

STREAM_PARTITIONS = ("device_type", "event_date")
REFERENCE_PARTITIONS = ("device_type", "window_start")


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


def spread_over_directories(df: DataFrame, partition_by, files_per_directory: int) -> DataFrame:
    """Shuffle the (already aggregated) rows so each output directory gets at
    most ``files_per_directory`` writer tasks per micro-batch.

    Without it every shuffle partition of the window aggregate writes a file
    into every directory it holds: partitions x directories small files per
    trigger. Salting by device keeps a hot directory spread over that many
    tasks instead of one. AQE does not run inside streaming queries, so the
    batch writer's ``rebalance`` hint is not available here.
    """
    salt_src = [F.col("device_id")] if "device_id" in df.columns else [F.col(c) for c in df.columns]
    salt = F.pmod(F.xxhash64(*salt_src), F.lit(files_per_directory))
    return df.repartition(*[F.col(c) for c in partition_by], salt)


def write_windows_stream(df: DataFrame, path: str, checkpoint: str, trigger: str | None = C.TRIGGER_INTERVAL,
                         partition_by=STREAM_PARTITIONS, available_now: bool = False,
                         query_name: str | None = None,
                         files_per_directory: int | None = C.STREAM_FILES_PER_DIRECTORY) -> StreamingQuery:
    """SNK1: append-mode Parquet, partitioned, with its own checkpoint.

    Default directories are (device_type, event_date): one per type and day.
    ``REFERENCE_PARTITIONS`` gives one directory per type and minute.
    ``files_per_directory`` bounds the files per directory and micro-batch
    (``None`` writes straight from the aggregate's partitions).
    """
    if "event_date" in partition_by and "event_date" not in df.columns:
        df = with_partition_date(df)
    if partition_by and files_per_directory:
        df = spread_over_directories(df, partition_by, files_per_directory)
    writer = (df.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint)
              .partitionBy(*partition_by))
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger, available_now).start()


def write_console_stream(df: DataFrame, trigger: str | None = C.TRIGGER_INTERVAL, rows: int = 100,
                         checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """SNK2: update-mode console output, no truncation (a debugging sink: each
    batch is printed by the driver)."""
    writer = (df.writeStream.outputMode("update").format("console")
              .option("truncate", "false").option("numRows", rows))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger, available_now).start()


def write_memory_stream(df: DataFrame, name: str, checkpoint: str, mode: str = "update",
                        available_now: bool = True) -> StreamingQuery:
    """In-memory table sink (tests and small interactive checks)."""
    writer = (df.writeStream.outputMode(mode).format("memory").queryName(name)
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, None, available_now).start()
