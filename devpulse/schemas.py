"""StructTypes for every table the operators read or produce."""

from pyspark.sql import types as T

from devpulse import constants as C

# The JSON payload. ``from_json`` makes every field nullable anyway, so the
# fields are declared nullable; validity is decided by the filters.
# ``event_id`` is a long: ids beyond int32 must not silently become NULL.
LOCATION = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
])

METADATA = T.StructType([
    T.StructField("firmware_version", T.StringType()),
    T.StructField("battery_level", T.IntegerType()),
    T.StructField("signal_strength", T.IntegerType()),
])

EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("event_duration", T.DoubleType()),
    T.StructField("location", LOCATION),
    T.StructField("metadata", METADATA),
])

# Same payload plus the column PERMISSIVE parsing fills for bad records.
EVENT_WITH_CORRUPT = T.StructType(
    EVENT.fields + [T.StructField("_corrupt_record", T.StringType())]
)

# The Kafka source's fixed row shape.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

FLAT_EVENT = T.StructType([
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("event_time_str", T.StringType()),
    T.StructField("event_duration", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("firmware_version", T.StringType()),
    T.StructField("battery_level", T.IntegerType()),
    T.StructField("signal_strength", T.IntegerType()),
    T.StructField("event_timestamp", T.TimestampType()),
])

WINDOW = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("avg_duration", T.DoubleType()),
    T.StructField("max_duration", T.DoubleType()),
    T.StructField("min_duration", T.DoubleType()),
    T.StructField("avg_battery_level", T.DoubleType()),
    T.StructField("min_battery_level", T.IntegerType()),
    T.StructField("avg_signal_strength", T.DoubleType()),
    T.StructField("min_signal_strength", T.IntegerType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("firmware_version", T.StringType()),
    T.StructField("last_event_time", T.TimestampType()),
])

REPORT = T.StructType([
    T.StructField("device_type", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("percentile_95", T.DoubleType()),
    T.StructField("mean_duration", T.DoubleType()),
    T.StructField("stddev_duration", T.DoubleType()),
    T.StructField("total_events", T.LongType()),
    T.StructField("distinct_devices", T.LongType()),
])

# A report read back from CSV: every column as text, typed by try_cast so
# that bad cells become NULL instead of failing the job.
REPORT_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in REPORT.fields])

# Raw device events as mapped from the supplied ``events`` table.
RAW_EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("event_duration", T.DoubleType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("battery_level", T.IntegerType()),
])

# What JSON input of the report job may hold: raw events, raw events with the time as text, stored windows.
JSON_INPUTS = {
    "raw": RAW_EVENT,
    "raw-text": T.StructType([f for f in RAW_EVENT.fields if f.name != "event_timestamp"]
                             + [T.StructField("event_time", T.StringType())]),
    "windows": WINDOW,
}


def event_contract() -> dict:
    """The JSON Schema document of the event payload."""
    def kind(t: T.DataType) -> dict:
        if isinstance(t, T.StructType):
            return {"type": "object", "properties": {f.name: kind(f.dataType) for f in t.fields}}
        return {"type": "string" if isinstance(t, T.StringType) else "number" if isinstance(t, T.DoubleType) else "integer"}

    doc = kind(EVENT)
    parts = doc["properties"]
    doc["required"] = C.REQUIRED_TOP_LEVEL
    parts["device_type"]["enum"] = C.DEVICE_TYPES
    parts["event_time"]["format"] = "date-time"
    parts["location"]["required"] = C.REQUIRED_LOCATION
    parts["metadata"]["required"] = C.REQUIRED_METADATA
    parts["metadata"]["properties"]["battery_level"] |= {"minimum": C.BATTERY_MIN, "maximum": C.BATTERY_MAX}
    parts["metadata"]["properties"]["signal_strength"] |= {"minimum": C.SIGNAL_MIN, "maximum": C.SIGNAL_MAX}
    return doc
