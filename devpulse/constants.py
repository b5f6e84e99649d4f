"""Fixed values that define the event contract and the default parameters.

These values must equal the behaviour being reproduced (field names,
validity ranges, device-type enum, window/watermark defaults), so they are
kept together here in natural order and shared by filters, reject reasons
and contract checks.
"""

# --- fixed values: validity ranges (inclusive unless stated) -------------
DURATION_MIN_EXCLUSIVE = 0.0      # event_duration > 0
DURATION_MAX_EXCLUSIVE = 100.0    # event_duration < 100
BATTERY_MIN = 0
BATTERY_MAX = 100
SIGNAL_MIN = -120
SIGNAL_MAX = 0
LATITUDE_MIN = -90.0
LATITUDE_MAX = 90.0
LONGITUDE_MIN = -180.0
LONGITUDE_MAX = 180.0

# --- fixed values: JSON contract ------------------------------------------
DEVICE_TYPES = ["sensor_A", "sensor_B", "camera", "thermo"]
REQUIRED_TOP_LEVEL = [
    "event_id", "device_id", "device_type", "event_time",
    "event_duration", "location", "metadata",
]
REQUIRED_LOCATION = ["latitude", "longitude", "city", "country"]
REQUIRED_METADATA = ["firmware_version", "battery_level", "signal_strength"]

# --- fixed values: event-time text formats, tried in this order -----------
EVENT_TIME_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
]

# --- fixed values: streaming defaults -------------------------------------
WINDOW_DURATION = "1 minute"
WATERMARK_DELAY = "2 minutes"
TRIGGER_INTERVAL = "30 seconds"
KAFKA_TOPIC = "input_events"
KAFKA_STARTING_OFFSETS = "latest"
MIN_BATCHES_TO_RETAIN = 10
DEDUP_KEYS = ["event_id", "device_id"]

# --- fixed values: percentile report defaults -----------------------------
PERCENTILE = 0.95
PERCENTILE_ACCURACY = 10000
OUTLIER_STD_DEVIATIONS = 3.0
MIN_POPULATION = 500
REPORT_MIN_TOTAL_EVENTS = 500     # hard-coded threshold of the report check

# --- fixed values: stored window table ------------------------------------
WINDOW_COLUMNS = [
    "window_start", "window_end", "device_id", "device_type",
    "event_count", "avg_duration", "max_duration", "min_duration",
    "avg_battery_level", "min_battery_level",
    "avg_signal_strength", "min_signal_strength",
    "city", "country", "firmware_version", "last_event_time",
]
CRITICAL_WINDOW_COLUMNS = ["device_id", "device_type", "event_count"]

# --- fixed values: percentile report table --------------------------------
REPORT_COLUMNS = [
    "device_type", "event_date", "percentile_95", "mean_duration",
    "stddev_duration", "total_events", "distinct_devices",
]

# --- our own defaults (not part of the reproduced behaviour) ---------------
# Streaming window sink: files per output directory and micro-batch; None
# writes straight from the aggregate's partitions (no extra shuffle, as many
# writers as the cluster has tasks).
STREAM_FILES_PER_DIRECTORY = None
