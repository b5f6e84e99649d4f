"""Independent DuckDB SQL for each registered query (run at sf0.01).

The envelope's injections are recomputed here straight from ``events`` with
integer arithmetic, not by parsing JSON, so parse + filter + de-dup + window
are checked against a separate derivation. Doubles are rounded to 6 places.
"""

from __future__ import annotations

from devpulse import constants as C

GATE = 50          # population gate at sf0.01
SPLIT_DAY = "2024-01-15"
LATE_SPLIT_DAY = "2024-01-02"

RAW = """raw AS (
  SELECT event_id, 'dev_' || CAST(user_id AS VARCHAR) AS device_id, event_type AS device_type,
         value AS event_duration, ts AS event_timestamp,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS battery_level
  FROM events)"""

PREP = RAW + """,
prep AS (
  SELECT event_duration, device_type, event_timestamp AS "timestamp", device_id, event_id,
         CAST(event_timestamp AS DATE) AS event_date
  FROM raw
  WHERE event_duration IS NOT NULL AND device_type IS NOT NULL AND event_timestamp IS NOT NULL
    AND event_duration > 0)"""

STATS = PREP + """,
stats AS (
  SELECT device_type, event_date, avg(event_duration) AS daily_mean,
         stddev_samp(event_duration) AS daily_stddev, count(DISTINCT device_id) AS distinct_events
  FROM prep GROUP BY device_type, event_date)"""


def _kept(gate: int = GATE, pop: str = "device_id", source: str = "prep") -> str:
    return f"""stats_g AS (
  SELECT device_type, event_date, avg(event_duration) AS daily_mean,
         stddev_samp(event_duration) AS daily_stddev, count(DISTINCT {pop}) AS distinct_events
  FROM {source} GROUP BY device_type, event_date),
kept AS (
  SELECT e.* FROM {source} e JOIN stats_g s USING (device_type, event_date)
  WHERE s.distinct_events >= {gate} AND abs(e.event_duration - s.daily_mean) <= 3.0 * s.daily_stddev)"""


REPORT_SELECT = """SELECT device_type, event_date,
       r6(quantile_disc(event_duration, 0.95)) AS percentile_95,
       r6(avg(event_duration)) AS mean_duration,
       r6(stddev_samp(event_duration)) AS stddev_duration,
       count(*) AS total_events, count(DISTINCT device_id) AS distinct_devices
FROM kept GROUP BY device_type, event_date"""

REPORT = "WITH " + PREP + ",\n" + _kept() + ",\nreport AS (" + REPORT_SELECT + ")"

_TIME_TEXT = """CASE WHEN event_id % 4 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
              WHEN event_id % 4 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
              WHEN event_id % 4 = 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END"""

FLAT = f"""src AS (
  SELECT *, event_id % 103 = 17 AS bad
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0)),
flat_all AS (
  SELECT ts AS kafka_timestamp, CAST(event_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
    CASE WHEN bad OR event_id % 101 = 13 THEN NULL ELSE event_id END AS event_id,
    CASE WHEN bad THEN NULL ELSE 'dev_' || CAST(user_id AS VARCHAR) END AS device_id,
    CASE WHEN bad THEN NULL ELSE event_type END AS device_type,
    CASE WHEN bad THEN NULL ELSE {_TIME_TEXT} END AS event_time_str,
    CASE WHEN bad THEN NULL WHEN event_id % 79 = 11 THEN CAST(-5.0 AS DOUBLE) ELSE value END AS event_duration,
    CASE WHEN bad THEN NULL WHEN event_id % 97 = 3 THEN CAST(200.0 AS DOUBLE)
         ELSE CAST(event_id % 181 - 90 AS DOUBLE) END AS latitude,
    CASE WHEN bad THEN NULL ELSE CAST(event_id % 361 - 180 AS DOUBLE) END AS longitude,
    CASE WHEN bad THEN NULL ELSE 'city_' || CAST(event_id % 20 AS VARCHAR) END AS city,
    CASE WHEN bad THEN NULL ELSE 'country_' || CAST(event_id % 7 AS VARCHAR) END AS country,
    CASE WHEN bad THEN NULL ELSE CAST(1 + event_id % 5 AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR)
         || '.0' END AS firmware_version,
    CASE WHEN bad THEN NULL WHEN event_id % 83 = 7 THEN 150
         ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS battery_level,
    CASE WHEN bad THEN NULL WHEN event_id % 89 = 5 THEN -200 ELSE CAST(-(event_id % 121) AS INTEGER) END
         AS signal_strength,
    CASE WHEN bad THEN NULL WHEN event_id % 4 IN (1, 3) THEN date_trunc('second', ts) ELSE ts END
         AS event_timestamp,
    bad AS malformed
  FROM src),
flat AS (SELECT * EXCLUDE (malformed) FROM flat_all)"""

# Events folded into 4 devices and 40 minutes, a third of the cities NULL.
DENSE = """dense AS (
  SELECT * REPLACE (user_id % 4 AS user_id,
                    make_timestamp(epoch_us(TIMESTAMP '2024-01-01') + epoch_us(ts) % 2400000000) AS ts)
  FROM events),
"""


def _dense(sql: str) -> str:
    return DENSE + (sql.replace("FROM events", "FROM dense")
                    .replace("WHEN bad THEN NULL ELSE 'city_'", "WHEN bad OR event_id % 3 = 0 THEN NULL ELSE 'city_'"))


VALID_PRED = f"""event_id IS NOT NULL AND device_id IS NOT NULL AND device_type IS NOT NULL
  AND event_timestamp IS NOT NULL
  AND event_duration > {C.DURATION_MIN_EXCLUSIVE} AND event_duration < {C.DURATION_MAX_EXCLUSIVE}
  AND battery_level BETWEEN {C.BATTERY_MIN} AND {C.BATTERY_MAX}
  AND signal_strength BETWEEN {C.SIGNAL_MIN} AND {C.SIGNAL_MAX}
  AND latitude BETWEEN {C.LATITUDE_MIN} AND {C.LATITUDE_MAX}
  AND longitude BETWEEN {C.LONGITUDE_MIN} AND {C.LONGITUDE_MAX}"""

VALID = FLAT + f""",
valid AS (SELECT * FROM flat WHERE {VALID_PRED}),
uniq AS (SELECT DISTINCT * FROM valid)"""


def _windows(seconds: int = 60) -> str:
    bucket = f"make_timestamp((epoch_us(event_timestamp) // {seconds * 1000000}) * {seconds * 1000000})"
    return VALID + f""",
w_in AS (SELECT *, {bucket} AS window_start FROM uniq),
win AS (
  SELECT window_start, window_start + INTERVAL {seconds} SECOND AS window_end, device_id, device_type,
    count(*) AS event_count,
    avg(event_duration) AS avg_duration, max(event_duration) AS max_duration,
    min(event_duration) AS min_duration,
    avg(battery_level) AS avg_battery_level, min(battery_level) AS min_battery_level,
    avg(signal_strength) AS avg_signal_strength, min(signal_strength) AS min_signal_strength,
    first(city ORDER BY event_timestamp, event_id) AS city,
    first(country ORDER BY event_timestamp, event_id) AS country,
    first(firmware_version ORDER BY event_timestamp, event_id) AS firmware_version,
    max(event_timestamp) AS last_event_time
  FROM w_in GROUP BY window_start, device_id, device_type)"""


WINDOWS = _windows(60)
# Append mode emits a window once the watermark (max event time - delay) passes its end.
WINDOWS_STREAM = WINDOWS + """,
win_emitted AS (SELECT * FROM win
  WHERE window_end <= (SELECT max(event_timestamp) FROM valid) - INTERVAL 2 MINUTE)"""

_ROUNDED = {"avg_duration", "max_duration", "min_duration", "avg_battery_level", "avg_signal_strength"}
WIN_COLS = ", ".join(f"r6({c}) AS {c}" if c in _ROUNDED else c for c in C.WINDOW_COLUMNS)
FLAT_COLS = ("kafka_timestamp, kafka_partition, kafka_offset, event_id, device_id, device_type, event_time_str, "
             "r6(event_duration) AS event_duration, r6(latitude) AS latitude, "
             "r6(longitude) AS longitude, city, country, firmware_version, battery_level, "
             "signal_strength, event_timestamp")
JOINED = """SELECT e.event_id, e.device_type, e.event_date, r6(e.event_duration) AS event_duration,
       r6(s.daily_mean) AS daily_mean, r6(s.daily_stddev) AS daily_stddev, s.distinct_events
FROM prep e JOIN stats s USING (device_type, event_date)"""
STATS_COLS = ("device_type, event_date, r6(daily_mean) AS daily_mean, r6(daily_stddev) AS daily_stddev, "
              "distinct_events")

WINDOW_TYPES = {
    "window_start": "timestamp", "window_end": "timestamp", "device_id": "string", "device_type": "string",
    "event_count": "bigint", "avg_duration": "double", "max_duration": "double", "min_duration": "double",
    "avg_battery_level": "double", "min_battery_level": "int", "avg_signal_strength": "double",
    "min_signal_strength": "int", "city": "string", "country": "string", "firmware_version": "string",
    "last_event_time": "timestamp",
}


def _dq1() -> str:
    parts = [f"SELECT '{c}' AS column_name, true AS expected, true AS present, '{t}' AS data_type, "
             f"count(*) AS row_count, count_if({c} IS NULL) AS null_count, 'ok' AS status FROM win"
             for c, t in WINDOW_TYPES.items()]
    return "WITH " + WINDOWS + "\n" + "\nUNION ALL ".join(parts)


def _flt(pred: str) -> str:
    return ("WITH " + FLAT + f"\nSELECT kafka_offset, kafka_partition, event_id, device_id FROM flat WHERE {pred}")


_DUR = f"event_duration > {C.DURATION_MIN_EXCLUSIVE} AND event_duration < {C.DURATION_MAX_EXCLUSIVE}"
_BAT = f"battery_level BETWEEN {C.BATTERY_MIN} AND {C.BATTERY_MAX}"
_SIG = f"signal_strength BETWEEN {C.SIGNAL_MIN} AND {C.SIGNAL_MAX}"
_COO = (f"latitude BETWEEN {C.LATITUDE_MIN} AND {C.LATITUDE_MAX} "
        f"AND longitude BETWEEN {C.LONGITUDE_MIN} AND {C.LONGITUDE_MAX}")


def _counts(source: str, label: str, rules: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{name}' AS {label}, count_if({cond}) AS row_count FROM {source}" for name, cond in rules]
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE row_count > 0"


def _contract_rules() -> list[tuple[str, str]]:
    """What each rule of the schema document finds; kafka_offset is the event id before it was made NULL."""
    ok = "NOT malformed"
    gone, null_type, text, array = (f"kafka_offset % {n} = {r}" for n, r in ((43, 7), (47, 9), (53, 11), (59, 13)))
    battery = f"{ok} AND NOT {gone}"
    return [("malformed_json", "malformed"), ("null:event_id", f"{ok} AND event_id IS NULL"),
            ("null:device_type", f"{ok} AND {null_type}"),
            ("enum:device_type", f"{ok} AND NOT {null_type} AND device_type NOT IN ("
             + ", ".join(f"'{t}'" for t in C.DEVICE_TYPES) + ")"),
            ("type:event_duration", f"{ok} AND {text}"), ("type:location", f"{ok} AND {array}"),
            ("required:metadata.battery_level", f"{ok} AND {gone}"),
            ("null:metadata.battery_level", f"{battery} AND battery_level IS NULL"),
            ("minimum:metadata.battery_level", f"{battery} AND battery_level < {C.BATTERY_MIN}"),
            ("maximum:metadata.battery_level", f"{battery} AND battery_level > {C.BATTERY_MAX}"),
            ("minimum:metadata.signal_strength", f"{ok} AND signal_strength < {C.SIGNAL_MIN}"),
            ("maximum:metadata.signal_strength", f"{ok} AND signal_strength > {C.SIGNAL_MAX}")]


def _faulty() -> dict[str, str]:
    """Checks on input that fails them."""
    q = {}
    null_type = "device_id LIKE '%7'"
    parts = []
    for c, t in WINDOW_TYPES.items():
        gone, nulls = c in ("city", "event_count"), f"count_if({null_type})" if c == "device_type" else f"count_if({c} IS NULL)"
        parts.append(f"SELECT '{c}' AS column_name, true AS expected, {str(not gone).lower()} AS present, "
                     + (f"NULL AS data_type, NULL::BIGINT AS row_count, NULL::BIGINT AS null_count, '{'fail' if c == 'event_count' else 'warn'}' AS status FROM win"
                        if gone else f"'{t}' AS data_type, count(*) AS row_count, {nulls} AS null_count, 'ok' AS status FROM win"))
    parts = [p if "NULL AS data_type" not in p else p.replace(" FROM win", "") for p in parts]
    parts.append("SELECT 'note', false, true, 'string', count(*), 0, 'extra' FROM win")
    q["DQ1_check_columns_faulty"] = "WITH " + WINDOWS + "\n" + "\nUNION ALL ".join(parts)
    q["DQ2_null_counts_faulty"] = ("WITH " + WINDOWS + f"\nSELECT 'device_id' AS column_name, 0::BIGINT AS null_count\n"
                                   f"UNION ALL SELECT 'device_type', count_if({null_type}) FROM win\nUNION ALL SELECT 'event_count', 0")
    q["DQ5_check_partitions_faulty"] = (
        "WITH " + WINDOWS + ",\nw AS (SELECT CAST(window_start AS DATE) AS d, CASE WHEN device_type = 'click' THEN 'x' "
        "WHEN device_type <> 'view' THEN device_type END AS t FROM win)\n"
        "SELECT count(DISTINCT t) AS distinct_types, count_if(d = DATE '2024-01-01') AS mismatched_rows, "
        "0::BIGINT AS rows_outside_partitions, 'table' AS place FROM w WHERE d <> DATE '2024-01-02'\n"
        "UNION ALL SELECT count(DISTINCT t), 0, count(*), 'beside' FROM w WHERE d = DATE '2024-01-02'")
    bad = "(day(event_date) % 3 = 0 OR day(event_date) % 5 = 0)"
    low = f"count_if(NOT {bad} AND total_events < {C.REPORT_MIN_TOTAL_EVENTS})"
    q["DQ6_validate_report_faulty"] = (
        REPORT + "\nSELECT 'has_header' AS \"check\", 'all' AS scope, 7.0::DOUBLE AS observed, 'pass' AS status\n"
        "UNION ALL SELECT 'columns_match', 'all', 7.0, 'pass'\n"
        "UNION ALL SELECT 'has_data', 'all', count(*)::DOUBLE, 'pass' FROM report\n"
        f"UNION ALL SELECT 'data_valid', 'all', count_if({bad})::DOUBLE, 'fail' FROM report\n"
        f"UNION ALL SELECT 'min_events_check', 'all', {low}::DOUBLE, CASE WHEN {low} = 0 THEN 'pass' ELSE 'fail' END FROM report")
    q["DQ6_report_file_missing"] = ("SELECT 'there' AS file, 'file_exists' AS \"check\", 'pass' AS status\n"
                                    "UNION ALL SELECT 'gone', 'file_exists', 'fail'")
    return q


def _expand_r6(sql: str) -> str:
    """r6(x) -> x rounded to 6 places through DECIMAL(38, 9), as Spark's side does.

    Plain ROUND on a binary double and Spark's decimal HALF_UP disagree on
    exact ties (averages of 2-decimal values over 64 rows end in ...5);
    going through a 9-place decimal first makes both engines agree.
    """
    out, i = [], 0
    while True:
        j = sql.find("r6(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + 2
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _expand_r6(sql[j + 3:k])
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST({inner} AS DECIMAL(38, 9)), 6) AS DOUBLE)")
        i = k + 1


def oracle_sql() -> dict[str, str]:
    return {k: _expand_r6(v) for k, v in _oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    q = {}
    q["SRC2_file_stream_envelope"] = ("WITH " + FLAT + "\nSELECT 'dev_' || CAST(user_id AS VARCHAR) AS kafka_key, "
                                      "ts AS kafka_timestamp, CAST(event_id % 4 AS INTEGER) AS kafka_partition, "
                                      "event_id AS kafka_offset FROM src")
    q["SRC2_PRJ1_stream_payload_leaves"] = "WITH " + FLAT + "\nSELECT " + FLAT_COLS.replace(", event_timestamp", "") \
        + " FROM flat"
    raw_sel = ("SELECT event_id, device_id, device_type, r6(event_duration) AS event_duration, "
               "event_timestamp, battery_level FROM raw")
    q["SRC3_read_parquet"] = "WITH " + RAW + "\n" + raw_sel
    q["SRC4_read_json_events"] = q["SRC3_read_parquet"]
    q["SRC5_read_any_json_fallback"] = q["SRC3_read_parquet"]
    q["SNK3_SRC6_report_csv_roundtrip"] = REPORT + "\nSELECT * FROM report"
    q["SNK4_report_parquet_roundtrip"] = q["SNK3_SRC6_report_csv_roundtrip"]
    q["PRJ1_project_envelope"] = ("WITH " + FLAT + "\nSELECT 'dev_' || CAST(user_id AS VARCHAR) AS kafka_key, "
                                  "ts AS kafka_timestamp, CAST(event_id % 4 AS INTEGER) AS kafka_partition, "
                                  "event_id AS kafka_offset, true AS has_payload FROM src")
    q["PRJ2_parse_payload"] = ("WITH " + FLAT + "\nSELECT kafka_offset, malformed, event_id, device_id, "
                               "event_time_str AS event_time, city, battery_level FROM flat_all")
    q["PRJ3_flatten_event"] = ("WITH " + FLAT + "\nSELECT " + FLAT_COLS.replace(", event_timestamp", "")
                               + " FROM flat")
    q["PRJ4_parse_event_time"] = "WITH " + FLAT + "\nSELECT kafka_offset, event_time_str, event_timestamp FROM flat"
    q["PRJ5_prepare_raw"] = ("WITH " + RAW + "\nSELECT r6(event_duration) AS event_duration, device_type, "
                             "event_timestamp AS \"timestamp\", device_id, event_id FROM raw")
    q["PRJ5_prepare_aggregated"] = ("WITH " + WINDOWS + "\nSELECT r6(avg_duration) AS event_duration, device_type, "
                                    "window_start AS \"timestamp\", device_id FROM win")
    q["PRJ6_event_date"] = ("WITH " + RAW + "\nSELECT r6(event_duration) AS event_duration, device_type, "
                            "event_timestamp AS \"timestamp\", device_id, event_id, "
                            "CAST(event_timestamp AS DATE) AS event_date FROM raw")
    q["FLT1_drop_unparsed"] = "WITH " + FLAT + "\nSELECT malformed, count(*) AS row_count FROM flat_all GROUP BY 1"
    q["FLT1_drop_null_and_empty_payloads"] = (
        "WITH " + FLAT + "\nSELECT kafka_offset, malformed FROM flat_all "
        "WHERE kafka_offset % 107 <> 19 AND kafka_offset % 109 <> 23")
    q["FLT2_valid_identity"] = _flt("event_id IS NOT NULL AND device_id IS NOT NULL AND device_type IS NOT NULL "
                                    "AND event_timestamp IS NOT NULL")
    q["FLT3_valid_duration"] = _flt(_DUR)
    q["FLT4_valid_battery"] = _flt(_BAT)
    q["FLT5_valid_signal"] = _flt(_SIG)
    q["FLT6_valid_coordinates"] = _flt(_COO)
    q["FLT7_filter_valid_records"] = "WITH " + VALID + "\nSELECT " + FLAT_COLS + " FROM valid"
    q["FLT8_positive_events"] = ("WITH " + PREP + "\nSELECT r6(event_duration) AS event_duration, device_type, "
                                 "\"timestamp\", device_id, event_id, event_date FROM prep")
    q["FLT8_positive_events_mixed"] = (
        "WITH " + PREP + "\nSELECT r6(event_duration) AS event_duration, device_type, \"timestamp\", device_id, "
        "event_id, event_date FROM prep WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 "
        "AND event_id % 17 <> 0")
    q["FLT9_within_sigma"] = ("WITH " + STATS + "\nSELECT e.event_id, e.device_type, e.event_date, "
                              "r6(e.event_duration) AS event_duration FROM prep e JOIN stats s "
                              "USING (device_type, event_date) "
                              "WHERE abs(e.event_duration - s.daily_mean) <= 3.0 * s.daily_stddev")
    q["FLT10_min_population"] = ("WITH " + STATS + f"\nSELECT {STATS_COLS} FROM stats "
                                 f"WHERE distinct_events >= {GATE}")
    q["JOIN1_attach_group_stats"] = "WITH " + STATS + "\n" + JOINED
    q["JOIN2_restrict_to_groups"] = ("WITH " + STATS + "\nSELECT event_id, device_type, event_date, "
                                     "r6(event_duration) AS event_duration FROM prep WHERE "
                                     "(device_type, event_date) IN (SELECT (device_type, event_date) FROM stats "
                                     f"WHERE distinct_events >= {GATE})")
    q["JOIN3_salted_join"] = q["JOIN1_attach_group_stats"]
    q["JOIN3_heavy_keys_join"] = q["JOIN1_attach_group_stats"]
    q["AGG1_PRJ7_window_aggregate"] = "WITH " + WINDOWS + f"\nSELECT {WIN_COLS} FROM win"
    q["AGG1_AGG2_dense_windows"] = "WITH " + _dense(WINDOWS) + f"\nSELECT {WIN_COLS} FROM win"
    q["AGG7_dense_event_count_stats"] = (
        "WITH " + _dense(WINDOWS) + "\nSELECT count(*) AS total_records, r6(avg(event_count)) AS avg_event_count, "
        "max(event_count) AS max_event_count, min(event_count) AS min_event_count FROM win")
    q["STR4_dense_stream_windows"] = "WITH " + _dense(WINDOWS_STREAM) + f"\nSELECT {WIN_COLS} FROM win_emitted"
    q["STR2_late_copy_then_on_time_copy"] = "WITH " + VALID + "\nSELECT " + FLAT_COLS + " FROM uniq"
    q["AGG2_first_by_time"] = ("WITH " + WINDOWS + "\nSELECT window_start, device_id, device_type, city, country, "
                               "firmware_version FROM win")
    q["AGG3_daily_stats"] = "WITH " + STATS + f"\nSELECT {STATS_COLS} FROM stats"
    q["AGG3_daily_stats_events_population"] = (
        "WITH " + PREP + "\nSELECT device_type, event_date, r6(avg(event_duration)) AS daily_mean, "
        "r6(stddev_samp(event_duration)) AS daily_stddev, count(DISTINCT event_id) AS distinct_events "
        "FROM prep GROUP BY device_type, event_date")
    q["AGG4_SRT1_percentile_report"] = REPORT + "\nSELECT * FROM report"
    q["AGG4_percentile_report_events_population"] = (
        "WITH " + PREP + ",\n" + _kept(pop="event_id") + ",\nreport AS (" + REPORT_SELECT + ")\nSELECT * FROM report")
    q["AGG4_percentile_report_aggregated_input"] = (
        "WITH " + WINDOWS + ",\nagg_in AS (SELECT avg_duration AS event_duration, device_type, device_id, "
        "CAST(window_start AS DATE) AS event_date FROM win WHERE avg_duration > 0),\n"
        + _kept(source="agg_in") + ",\nreport AS (" + REPORT_SELECT + ")\nSELECT * FROM report")
    q["AGG4_percentile_report_two_joins"] = q["AGG4_SRT1_percentile_report"]
    q["AGG4_percentile_report_approx_method"] = q["AGG4_SRT1_percentile_report"]
    q["AGG4_two_level_sketch_rank_error"] = ("WITH " + PREP + "\nSELECT device_type, count(*) AS total_events, "
                                             "true AS within_error FROM prep GROUP BY device_type")
    q["AGG5_exact_percentile_disc"] = q["AGG4_SRT1_percentile_report"]
    q["AGG5_SRT1_percentile_report_exact_method"] = q["AGG4_SRT1_percentile_report"]
    q["AGG5_exact_percentile_cont"] = REPORT.replace("quantile_disc", "quantile_cont") + "\nSELECT * FROM report"
    q["AGG6_report_summary"] = (REPORT + "\nSELECT count(*) AS total_device_type_days, "
                                "r6(avg(percentile_95)) AS avg_percentile_95, "
                                "r6(avg(mean_duration)) AS avg_mean_duration, "
                                "r6(avg(total_events)) AS avg_events_per_day FROM report")
    q["AGG7_event_count_stats"] = ("WITH " + WINDOWS + "\nSELECT count(*) AS total_records, "
                                   "r6(avg(event_count)) AS avg_event_count, max(event_count) AS max_event_count, "
                                   "min(event_count) AS min_event_count FROM win")
    q["AGG8_type_distribution"] = "WITH " + WINDOWS + "\nSELECT device_type, count(*) AS row_count FROM win GROUP BY 1"
    q["AGG9_distinct_types"] = "WITH " + WINDOWS + "\nSELECT DISTINCT device_type FROM win"
    q["AGG10_row_count"] = "WITH " + WINDOWS + "\nSELECT count(*) AS row_count FROM win"
    q["LIM1_top_report_rows"] = REPORT + "\nSELECT * FROM report ORDER BY device_type, event_date LIMIT 10"
    q["STR2_dedup_batch"] = "WITH " + VALID + "\nSELECT " + FLAT_COLS + " FROM uniq"
    q["STR2_dedup_within_watermark_stream"] = q["STR2_dedup_batch"]
    q["STR3_tumbling_window_30s"] = "WITH " + _windows(30) + f"\nSELECT {WIN_COLS} FROM win"
    q["STR4_SNK1_stream_windows"] = "WITH " + WINDOWS_STREAM + f"\nSELECT {WIN_COLS} FROM win_emitted"
    q["STR4_stream_windows_unbounded_dedup"] = q["STR4_SNK1_stream_windows"]
    q["STR8_resume_from_checkpoint"] = q["STR4_SNK1_stream_windows"]
    q["STR2_STR4_stream_windows_pre_dedup"] = q["STR4_SNK1_stream_windows"]
    q["STR2_STR4_stream_windows_no_pre_dedup"] = q["STR4_SNK1_stream_windows"]
    # late run: windows of the held-back days never appear
    q["STR5_late_arrivals_dropped"] = ("WITH " + WINDOWS_STREAM + f"\nSELECT {WIN_COLS} FROM win_emitted "
                                       f"WHERE CAST(window_start AS DATE) > DATE '{LATE_SPLIT_DAY}'")
    q["STR5_STR7_rows_dropped_over_all_batches"] = (
        "WITH " + VALID + "\nSELECT count(*) AS rows_dropped FROM valid "
        f"WHERE CAST(kafka_timestamp AS DATE) <= DATE '{LATE_SPLIT_DAY}'")
    q["STR6_update_mode_latest_windows"] = "WITH " + WINDOWS + f"\nSELECT {WIN_COLS} FROM win"
    # A key is kept while its time and the delay are past the watermark, a window while its end is.
    q["STR1_STR2_keys_left_in_state"] = (
        "WITH " + _dense(VALID) + "\nSELECT event_id, device_id FROM uniq "
        "WHERE event_timestamp + INTERVAL 2 MINUTE > (SELECT max(event_timestamp) FROM valid) - INTERVAL 2 MINUTE")
    q["STR1_STR4_windows_left_in_state"] = (
        "WITH " + _dense(WINDOWS) + "\nSELECT window_start, window_end, device_id, device_type FROM win "
        "WHERE window_end > (SELECT max(event_timestamp) FROM valid) - INTERVAL 2 MINUTE")
    q["SNK1_compacted_windows"] = q["STR4_SNK1_stream_windows"]
    q["SNK1_compaction_file_bound"] = (
        "WITH " + WINDOWS_STREAM + "\nSELECT device_type, CAST(window_start AS DATE) AS event_date, count(*) AS row_count, "
        "true AS within_bound FROM win_emitted GROUP BY ALL")
    q["DQ1_check_columns"] = _dq1()
    crit = C.CRITICAL_WINDOW_COLUMNS
    q["DQ2_null_counts"] = ("WITH " + WINDOWS + "\n" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS null_count FROM win" for c in crit))
    q["DQ3_check_non_empty"] = ("WITH " + WINDOWS + "\nSELECT 'non_empty' AS \"check\", 'all' AS scope, "
                                "CAST(least(count(*), 1) AS DOUBLE) AS observed, "
                                "CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status FROM win")
    dq4 = ["SELECT 'row_count' AS \"check\", 'all' AS scope, CAST(count(*) AS DOUBLE) AS observed, "
           "CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status FROM win"]
    dq4 += [f"SELECT 'null_{c}', 'all', CAST(count_if({c} IS NULL) AS DOUBLE), "
            f"CASE WHEN count_if({c} IS NULL) > 0 THEN 'warn' ELSE 'pass' END FROM win" for c in crit]
    dq4 += ["SELECT 'avg_event_count', 'all', r6(avg(event_count)), 'info' FROM win",
            "SELECT 'max_event_count', 'all', CAST(max(event_count) AS DOUBLE), 'info' FROM win",
            "SELECT 'min_event_count', 'all', CAST(min(event_count) AS DOUBLE), 'info' FROM win",
            "SELECT 'type_count', device_type, CAST(count(*) AS DOUBLE), 'info' FROM win GROUP BY device_type"]
    q["DQ4_quality_report"] = "WITH " + WINDOWS + "\n" + "\nUNION ALL ".join(dq4)
    q["DQ5_check_partitions"] = ("WITH " + WINDOWS + "\nSELECT count(DISTINCT device_type) AS distinct_types, "
                                 "CAST(0 AS BIGINT) AS mismatched_rows, CAST(0 AS BIGINT) AS rows_outside_partitions "
                                 "FROM win")
    q["DQ6_validate_report"] = (
        REPORT + ",\nchk AS (SELECT count(*) AS n, count(*) FILTER (WHERE percentile_95 > 0 AND mean_duration > 0 "
        "AND total_events > 0 AND distinct_devices > 0) AS v, count(*) FILTER (WHERE percentile_95 > 0 AND "
        f"mean_duration > 0 AND total_events > 0 AND distinct_devices > 0 AND total_events < {C.REPORT_MIN_TOTAL_EVENTS})"
        " AS low FROM report)\n"
        "SELECT 'has_header' AS \"check\", 'all' AS scope, 7.0::DOUBLE AS observed, 'pass' AS status\n"
        "UNION ALL SELECT 'columns_match', 'all', 7.0, 'pass'\n"
        "UNION ALL SELECT 'has_data', 'all', n::DOUBLE, CASE WHEN n > 0 THEN 'pass' ELSE 'fail' END FROM chk\n"
        "UNION ALL SELECT 'data_valid', 'all', (n - v)::DOUBLE, CASE WHEN v = n THEN 'pass' ELSE 'fail' END FROM chk\n"
        "UNION ALL SELECT 'min_events_check', 'all', low::DOUBLE, CASE WHEN low = 0 THEN 'pass' ELSE 'fail' END "
        "FROM chk")
    required = [("malformed_json", "malformed"), ("required:event_id", "malformed OR event_id IS NULL")]
    required += [(f"required:{n}", "malformed") for n in C.REQUIRED_TOP_LEVEL if n != "event_id"]
    required += [("enum:device_type", "NOT malformed AND device_type NOT IN ("
                  + ", ".join(f"'{t}'" for t in C.DEVICE_TYPES) + ")"),
                 ("range:battery_level", f"NOT malformed AND NOT ({_BAT})"),
                 ("range:signal_strength", f"NOT malformed AND NOT ({_SIG})")]
    q["DQ7_contract_violations"] = "WITH " + FLAT + "\n" + _counts("flat_all", "rule", required)
    reasons = [("malformed_json", "malformed"), ("missing_event_id", "event_id IS NULL"),
               ("missing_device_id", "device_id IS NULL"), ("missing_device_type", "device_type IS NULL"),
               ("bad_event_time", "event_timestamp IS NULL"),
               ("bad_duration", f"event_duration IS NULL OR NOT ({_DUR})"),
               ("bad_battery_level", f"battery_level IS NULL OR NOT ({_BAT})"),
               ("bad_signal_strength", f"signal_strength IS NULL OR NOT ({_SIG})"),
               ("bad_coordinates", f"latitude IS NULL OR longitude IS NULL OR NOT ({_COO})")]
    q["DQ10_reject_reasons"] = "WITH " + FLAT + "\n" + _counts("flat_all", "reason", reasons)
    q["DQ7_contract_from_schema_file"] = "WITH " + FLAT + "\n" + _counts("flat_all", "rule", _contract_rules())
    q.update(_faulty())
    q["DQ8_storage_inventory"] = ("WITH " + WINDOWS + "\nSELECT device_type, "
                                  "count(DISTINCT CAST(window_start AS DATE)) AS partitions FROM win GROUP BY 1")
    q["DQ11_inventory_delta"] = ("WITH " + WINDOWS + "\nSELECT device_type, "
                                 "count(DISTINCT CAST(window_start AS DATE)) AS new_partitions FROM win "
                                 f"WHERE CAST(window_start AS DATE) > DATE '{SPLIT_DAY}' GROUP BY 1")
    q["DQ1_DQ4_DQ5_window_store_validation"] = (
        "WITH " + WINDOWS + "\nSELECT 'read_successful' AS step, true AS passed, '' AS detail\n"
        "UNION ALL SELECT 'schema_valid', true, ''\n"
        "UNION ALL SELECT 'data_quality_valid', count(*) > 0, "
        "CASE WHEN count(*) > 0 THEN '' ELSE 'row_count=fail' END FROM win\n"
        "UNION ALL SELECT 'partitions_valid', count(*) >= 0, '' FROM win")
    return q
