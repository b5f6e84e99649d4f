"""The supplied tables and their mapping onto the device-event shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_raw(events: DataFrame) -> DataFrame:
    """``events`` -> raw device events.

    user_id -> device_id ('dev_' prefix), event_type -> device_type,
    value -> event_duration, ts (NTZ) -> event_timestamp (session-zone
    TIMESTAMP), props.k -> battery_level. Pure projection: the Parquet scan
    keeps only the columns later operators use.
    """
    return events.select(
        F.col("event_id"),
        F.concat(F.lit("dev_"), F.col("user_id").cast("string")).alias("device_id"),
        F.col("event_type").alias("device_type"),
        F.col("value").alias("event_duration"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.get_json_object("props", "$.k").cast("int").alias("battery_level"),
    )
