"""Projections and filters of the ingest path (PRJ1-PRJ6, FLT1-FLT8).

All are lazy ``DataFrame -> DataFrame`` functions that work unchanged on
batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from devpulse import schemas
from devpulse.functions import predicates as P
from devpulse.functions.time import parse_event_time_expr


def project_envelope(df: DataFrame) -> DataFrame:
    """PRJ1: key/value bytes -> text; Kafka metadata renamed ``kafka_*``."""
    return df.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("json_value"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def parse_payload(df: DataFrame, schema: StructType = schemas.EVENT_WITH_CORRUPT,
                  column: str = "json_value") -> DataFrame:
    """PRJ2: JSON text -> ``parsed_data`` struct (PERMISSIVE).

    A malformed payload gives a struct of NULLs whose ``_corrupt_record``
    holds the text; only a NULL or empty payload gives a NULL struct.
    """
    return df.withColumn("parsed_data", F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"}))


def drop_unparsed(df: DataFrame) -> DataFrame:
    """FLT1: drop rows whose payload parsed to NULL."""
    return df.filter(F.col("parsed_data").isNotNull())


def flatten_event(df: DataFrame, keep_corrupt: bool = False) -> DataFrame:
    """PRJ3: pull the 12 leaf fields out of the payload struct."""
    p = "parsed_data"
    cols = [
        F.col("kafka_timestamp"), F.col("kafka_partition"), F.col("kafka_offset"),
        F.col(f"{p}.event_id").alias("event_id"),
        F.col(f"{p}.device_id").alias("device_id"),
        F.col(f"{p}.device_type").alias("device_type"),
        F.col(f"{p}.event_time").alias("event_time_str"),
        F.col(f"{p}.event_duration").alias("event_duration"),
        F.col(f"{p}.location.latitude").alias("latitude"),
        F.col(f"{p}.location.longitude").alias("longitude"),
        F.col(f"{p}.location.city").alias("city"),
        F.col(f"{p}.location.country").alias("country"),
        F.col(f"{p}.metadata.firmware_version").alias("firmware_version"),
        F.col(f"{p}.metadata.battery_level").alias("battery_level"),
        F.col(f"{p}.metadata.signal_strength").alias("signal_strength"),
    ]
    if keep_corrupt:
        cols.append(F.col(f"{p}._corrupt_record").alias("_corrupt_record"))
    return df.select(*cols)


def parse_event_time(df: DataFrame, text_col: str = "event_time_str",
                     out_col: str = "event_timestamp") -> DataFrame:
    """PRJ4: ISO-8601 text -> ``event_timestamp`` (first fitting shape wins)."""
    return df.withColumn(out_col, parse_event_time_expr(F.col(text_col)))


def parse_events(df: DataFrame, keep_corrupt: bool = False) -> DataFrame:
    """PRJ1 -> PRJ2 -> FLT1 -> PRJ3 -> PRJ4: envelope to flat events."""
    flat = flatten_event(drop_unparsed(parse_payload(project_envelope(df))), keep_corrupt)
    return parse_event_time(flat)


def valid_identity(df: DataFrame) -> DataFrame:
    """FLT2."""
    return df.filter(P.valid_identity())


def valid_duration(df: DataFrame) -> DataFrame:
    """FLT3."""
    return df.filter(P.valid_duration())


def valid_battery(df: DataFrame) -> DataFrame:
    """FLT4."""
    return df.filter(P.valid_battery())


def valid_signal(df: DataFrame) -> DataFrame:
    """FLT5."""
    return df.filter(P.valid_signal())


def valid_coordinates(df: DataFrame) -> DataFrame:
    """FLT6."""
    return df.filter(P.valid_coordinates())


def filter_valid_records(df: DataFrame) -> DataFrame:
    """FLT7: one filter with the whole conjunction (pushed as one predicate)."""
    return df.filter(P.valid_record())


def prepare_events(df: DataFrame, mode: str = "auto") -> DataFrame:
    """PRJ5: raw or window-aggregated input -> (event_duration, device_type,
    timestamp, device_id [, event_id]).

    ``auto`` picks raw when ``event_duration`` exists, else aggregated
    (``avg_duration`` at ``window_start``), else raises ``ValueError``.
    Raw input carrying only ``event_time`` text gets its timestamp parsed.
    ``event_id`` is kept when present (used by the "events" population).
    """
    cols = set(df.columns)
    if mode == "auto":
        mode = "raw" if "event_duration" in cols else ("aggregated" if "avg_duration" in cols else None)
    if mode == "raw":
        if "event_timestamp" in cols:
            ts = F.col("event_timestamp")
        elif "event_time" in cols:
            ts = parse_event_time_expr(F.col("event_time"))
        elif "event_time_str" in cols:
            ts = parse_event_time_expr(F.col("event_time_str"))
        else:
            raise ValueError("raw events need event_timestamp or event_time")
        out = [F.col("event_duration"), F.col("device_type"), ts.alias("timestamp"), F.col("device_id")]
        if "event_id" in cols:
            out.append(F.col("event_id"))
        return df.select(*out)
    if mode == "aggregated":
        return df.select(
            F.col("avg_duration").alias("event_duration"),
            F.col("device_type"),
            F.col("window_start").alias("timestamp"),
            F.col("device_id"),
        )
    raise ValueError("no duration column: expected raw events (event_duration) or windows (avg_duration)")


def with_event_date(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """PRJ6: calendar day of the event (session time zone)."""
    return df.withColumn("event_date", F.to_date(F.col(ts_col)))


def positive_events(df: DataFrame) -> DataFrame:
    """FLT8: keep rows with type, date and a positive duration."""
    return df.filter(P.positive_event())
