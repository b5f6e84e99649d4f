"""Readers: Kafka, files (stream and batch), the supplied tables."""

from devpulse.sources.kafka import kafka_options, read_kafka_events
from devpulse.sources.files import (
    read_event_files_stream, read_parquet, read_json_events, read_any, read_report_csv,
)
from devpulse.sources.tables import load_table, events_as_raw
from devpulse.sources.fixtures import build_envelope

__all__ = [
    "kafka_options", "read_kafka_events", "read_event_files_stream", "read_parquet",
    "read_json_events", "read_any", "read_report_csv", "load_table", "events_as_raw",
    "build_envelope",
]
