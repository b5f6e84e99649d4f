"""Registered queries: one callable per operator ID of the inventory.

Each takes ``(spark, sf_dir)``, reads the supplied ``events`` table (or data
Spark derives from it: the Kafka-shaped envelope, written files, the report)
and returns a DataFrame whose columns match the SQL in ``oracle_sql``.
Doubles are rounded to 6 places and timestamps cast to NTZ only at the very
end, for the comparison.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from devpulse import constants as C
from devpulse import schemas
from devpulse.operators import percentile as PCT
from devpulse.operators import quality as Q
from devpulse.operators import transform as TR
from devpulse.operators import contract
from devpulse.operators.joins import salted_join, skew_join
from devpulse.operators.sketch_quantile import rank_error, two_level_quantile
from devpulse.operators.windows import deduplicate, window_aggregate
from devpulse.plans import etl
from devpulse.plans.report import percentile_report, percentile_report_two_joins, report_input
from devpulse.plans.staging import stage_table
from devpulse.session import ensure_defaults, scratch_path
from devpulse.sinks import write_report, write_windows
from devpulse.sources import files as SRC
from devpulse.sources.fixtures import build_envelope, dense_events, with_broken_payloads, with_missing_payloads
from devpulse.sources.tables import events_as_raw, load_table
from devpulse.streaming import compaction, state, upsert
from devpulse.streaming.etl import deduplicate_stream, stream_windows, with_event_watermark
from devpulse.streaming.progress import ProgressLog
from devpulse.streaming.sinks import STREAM_PARTITIONS, write_windows_stream

# Population gate of the registered queries (distinct devices per type and day).
GATE = 50
# Rows of days up to this one are held back and delivered late (STR5).
LATE_SPLIT_DAY = "2024-01-02"


def comparable(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places (via DECIMAL(38, 9)) and cast TIMESTAMP -> TIMESTAMP_NTZ."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # through a 9-place decimal so exact ties round the same in the SQL check
            c = F.round(c.cast("decimal(38,9)"), 6).cast("double")
        cols.append(c.alias(f.name))
    return df.select(cols)


# --- inputs -----------------------------------------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_defaults(spark)
    return load_table(spark, sf_dir, "events")


def raw(spark, sf_dir):
    return events_as_raw(events(spark, sf_dir))


def envelope(spark, sf_dir):
    return build_envelope(events(spark, sf_dir))


def flat(spark, sf_dir, keep_corrupt=False):
    return TR.parse_events(envelope(spark, sf_dir), keep_corrupt)


def windows(spark, sf_dir):
    return etl.window_table(envelope(spark, sf_dir))


def report(spark, sf_dir):
    return percentile_report(raw(spark, sf_dir), min_population=GATE)


def stats(spark, sf_dir, population="devices"):
    return PCT.daily_stats(report_input(raw(spark, sf_dir)), population)


def dense_envelope(spark, sf_dir):
    """About eleven valid events a window at sf0.01; a third of the cities is NULL."""
    return build_envelope(dense_events(events(spark, sf_dir)), null_city_every=3)


def _write_envelope(spark, sf_dir, source=envelope) -> str:
    path = scratch_path(spark, "envelope")
    source(spark, sf_dir).write.parquet(path)
    return path


def _run_available_now(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


# --- sources and sinks ---------------------------------------------------------

def q_src2(spark, sf_dir):
    src = _write_envelope(spark, sf_dir)
    out, ck = scratch_path(spark, "src2-out"), scratch_path(spark, "src2-ck")
    stream = TR.project_envelope(SRC.read_event_files_stream(spark, src)).drop("json_value")
    _run_available_now(stream.writeStream.format("parquet").option("path", out)
                       .option("checkpointLocation", ck).trigger(availableNow=True).start())
    return comparable(SRC.read_parquet(spark, out))


def q_src2_payload(spark, sf_dir):
    """The streamed and stored payload text, compared by all its leaves."""
    src = _write_envelope(spark, sf_dir)
    out, ck = scratch_path(spark, "src2-payload-out"), scratch_path(spark, "src2-payload-ck")
    stream = TR.project_envelope(SRC.read_event_files_stream(spark, src))
    _run_available_now(stream.writeStream.format("parquet").option("path", out)
                       .option("checkpointLocation", ck).trigger(availableNow=True).start())
    return comparable(TR.flatten_event(TR.parse_payload(SRC.read_parquet(spark, out))))


_JSON_TS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _write_raw_json(spark, sf_dir) -> str:
    path = scratch_path(spark, "raw-json")
    raw(spark, sf_dir).write.options(**_JSON_TS).json(path)
    return path


def q_src3(spark, sf_dir):
    return comparable(SRC.read_parquet(spark, f"{sf_dir.rstrip('/')}/events.parquet").transform(events_as_raw))


def q_src4(spark, sf_dir):
    path = _write_raw_json(spark, sf_dir)
    return comparable(SRC.read_json_events(spark, path, schemas.RAW_EVENT, _JSON_TS))


def q_src5(spark, sf_dir):
    path = _write_raw_json(spark, sf_dir)
    # the folder holds JSON lines, so the Parquet attempt fails and JSON is read
    return comparable(SRC.read_any(spark, path, schemas.RAW_EVENT, _JSON_TS))


def q_snk3_src6(spark, sf_dir):
    path = scratch_path(spark, "report-csv")
    write_report(report(spark, sf_dir), path, "csv")
    return comparable(SRC.read_report_csv(spark, path))


def q_snk4(spark, sf_dir):
    path = scratch_path(spark, "report-parquet")
    write_report(report(spark, sf_dir), path, "parquet")
    return comparable(SRC.read_parquet(spark, path))


# --- projections -----------------------------------------------------------------

def q_prj1(spark, sf_dir):
    p = TR.project_envelope(envelope(spark, sf_dir))
    return comparable(p.select("kafka_key", "kafka_timestamp", "kafka_partition", "kafka_offset",
                               (F.length("json_value") > 0).alias("has_payload")))


def q_prj2(spark, sf_dir):
    p = TR.parse_payload(TR.project_envelope(envelope(spark, sf_dir)))
    return comparable(p.select(
        "kafka_offset",
        F.col("parsed_data._corrupt_record").isNotNull().alias("malformed"),
        F.col("parsed_data.event_id").alias("event_id"),
        F.col("parsed_data.device_id").alias("device_id"),
        F.col("parsed_data.event_time").alias("event_time"),
        F.col("parsed_data.location.city").alias("city"),
        F.col("parsed_data.metadata.battery_level").alias("battery_level"),
    ))


def q_prj3(spark, sf_dir):
    p = TR.flatten_event(TR.drop_unparsed(TR.parse_payload(TR.project_envelope(envelope(spark, sf_dir)))))
    return comparable(p)


def q_prj4(spark, sf_dir):
    return comparable(flat(spark, sf_dir).select("kafka_offset", "event_time_str", "event_timestamp"))


def q_prj5_raw(spark, sf_dir):
    return comparable(TR.prepare_events(raw(spark, sf_dir)))


def q_prj5_aggregated(spark, sf_dir):
    return comparable(TR.prepare_events(windows(spark, sf_dir)))


def q_prj6(spark, sf_dir):
    return comparable(TR.with_event_date(TR.prepare_events(raw(spark, sf_dir))))


# --- filters ----------------------------------------------------------------------

def q_flt1(spark, sf_dir):
    p = TR.drop_unparsed(TR.parse_payload(TR.project_envelope(envelope(spark, sf_dir))))
    return (p.groupBy(F.col("parsed_data._corrupt_record").isNotNull().alias("malformed"))
            .agg(F.count(F.lit(1)).alias("row_count")))


def q_flt1_missing(spark, sf_dir):
    """NULL and empty payloads go; malformed ones stay visible."""
    p = TR.project_envelope(with_missing_payloads(envelope(spark, sf_dir)))
    return TR.drop_unparsed(TR.parse_payload(p)).select(
        "kafka_offset", F.col("parsed_data._corrupt_record").isNotNull().alias("malformed"))


def _flt(op):
    def run(spark, sf_dir):
        return comparable(op(flat(spark, sf_dir)).select("kafka_offset", "kafka_partition", "event_id", "device_id"))
    return run


def q_flt7(spark, sf_dir):
    return comparable(TR.filter_valid_records(flat(spark, sf_dir)))


def q_flt8(spark, sf_dir):
    return comparable(report_input(raw(spark, sf_dir)))


def q_flt8_mixed(spark, sf_dir):
    """Durations that are NULL, zero and negative, and NULL types, among the valid ones."""
    k = F.col("event_id")
    mixed = (F.when(k % 7 == 0, F.lit(None).cast("double")).when(k % 11 == 0, F.lit(0.0))
             .when(k % 13 == 0, -F.col("event_duration")).otherwise(F.col("event_duration")))
    rows = (raw(spark, sf_dir).withColumn("event_duration", mixed)
            .withColumn("device_type", F.when(k % 17 != 0, F.col("device_type"))))
    return comparable(report_input(rows))


def _events_with_stats(spark, sf_dir, gated=False):
    ev = report_input(raw(spark, sf_dir))
    st = stage_table(PCT.daily_stats(ev), "daily-stats")
    if gated:
        st = PCT.min_population(st, GATE)
    return ev, st


def q_flt9(spark, sf_dir):
    ev, st = _events_with_stats(spark, sf_dir)
    kept = PCT.within_sigma(PCT.attach_group_stats(ev, st))
    return comparable(kept.select("event_id", "device_type", "event_date", "event_duration"))


def q_flt10(spark, sf_dir):
    return comparable(PCT.min_population(stats(spark, sf_dir), GATE))


# --- joins -------------------------------------------------------------------------

_JOINED = ["event_id", "device_type", "event_date", "event_duration", "daily_mean", "daily_stddev",
           "distinct_events"]


def q_join1(spark, sf_dir):
    ev, st = _events_with_stats(spark, sf_dir)
    return comparable(PCT.attach_group_stats(ev, st).select(*_JOINED))


def q_join2(spark, sf_dir):
    ev, st = _events_with_stats(spark, sf_dir, gated=True)
    return comparable(PCT.restrict_to_groups(ev, st).select("event_id", "device_type", "event_date",
                                                            "event_duration"))


def q_join3(spark, sf_dir):
    ev, st = _events_with_stats(spark, sf_dir)
    return comparable(salted_join(ev, st, PCT.GROUP_KEYS, "inner", salts=8).select(*_JOINED))


def q_join3_heavy(spark, sf_dir):
    """A fifth of the keys are heavy at this share: only they are salted."""
    ev, st = _events_with_stats(spark, sf_dir)
    return comparable(skew_join(ev, st, PCT.GROUP_KEYS, "inner", salts=8, share=0.0075).select(*_JOINED))


# --- aggregations ------------------------------------------------------------------

def q_agg1(spark, sf_dir):
    return comparable(windows(spark, sf_dir))


def q_agg1_dense(spark, sf_dir):
    return comparable(etl.window_table(dense_envelope(spark, sf_dir)))


def q_agg7_dense(spark, sf_dir):
    return comparable(Q.event_count_stats(etl.window_table(dense_envelope(spark, sf_dir))))


def q_agg2(spark, sf_dir):
    return comparable(windows(spark, sf_dir).select("window_start", "device_id", "device_type", "city",
                                                    "country", "firmware_version"))


def q_agg3(spark, sf_dir):
    return comparable(stats(spark, sf_dir))


def q_agg3_events(spark, sf_dir):
    return comparable(stats(spark, sf_dir, "events"))


def q_agg4(spark, sf_dir):
    return comparable(report(spark, sf_dir))


def q_agg4_approx(spark, sf_dir):
    return comparable(percentile_report(raw(spark, sf_dir), min_population=GATE, method="approx"))


#: Rows that a sketch keeps whole in the registered check of its rank error.
SMALL_SKETCH = 400


def q_agg4_rank_error(spark, sf_dir):
    """A sketch much smaller than the groups: the share of rows at or below its answer is p, within three times the
    stated error (a random sketch may miss once the 99 % bound)."""
    ev = report_input(raw(spark, sf_dir))
    found = two_level_quantile(ev.repartition(16), ["device_type"], "event_duration", C.PERCENTILE, "q", SMALL_SKETCH, 4)
    share = F.avg((F.col("event_duration") <= F.col("q")).cast("double"))
    return (ev.join(F.broadcast(found), "device_type").groupBy("device_type")
            .agg(F.max("_rows").alias("total_events"),
                 (F.abs(share - C.PERCENTILE) <= 3 * rank_error(SMALL_SKETCH)).alias("within_error")))


def q_agg4_events(spark, sf_dir):
    return comparable(percentile_report(raw(spark, sf_dir), min_population=GATE, population="events"))


def q_agg4_aggregated(spark, sf_dir):
    return comparable(percentile_report(windows(spark, sf_dir), min_population=GATE))


def q_agg4_two_joins(spark, sf_dir):
    return comparable(percentile_report_two_joins(raw(spark, sf_dir), min_population=GATE))


def _kept(spark, sf_dir):
    ev, st = _events_with_stats(spark, sf_dir)
    st = PCT.min_population(st, GATE)
    return PCT.within_sigma(PCT.attach_group_stats(ev, st))


def q_agg5_report_method(spark, sf_dir):
    """The flagship report with ``method="disc"`` (exact p95, report order)."""
    return comparable(percentile_report(raw(spark, sf_dir), min_population=GATE, method="disc"))


def q_agg5_disc(spark, sf_dir):
    return comparable(PCT.daily_percentile_exact(_kept(spark, sf_dir), method="disc"))


def q_agg5_cont(spark, sf_dir):
    return comparable(PCT.daily_percentile_exact(_kept(spark, sf_dir), method="cont"))


def q_agg6(spark, sf_dir):
    return comparable(PCT.report_summary(report(spark, sf_dir)))


def q_agg7(spark, sf_dir):
    return comparable(Q.event_count_stats(windows(spark, sf_dir)))


def q_agg8(spark, sf_dir):
    return Q.type_distribution(windows(spark, sf_dir))


def q_agg9(spark, sf_dir):
    return Q.distinct_types(windows(spark, sf_dir))


def q_agg10(spark, sf_dir):
    return Q.row_count(windows(spark, sf_dir))


def q_lim1(spark, sf_dir):
    return comparable(PCT.top_rows(report(spark, sf_dir), 10))


# --- streaming -----------------------------------------------------------------------

def q_str2_batch(spark, sf_dir):
    return comparable(deduplicate(etl.clean_events(envelope(spark, sf_dir))))


def q_str2_stream(spark, sf_dir):
    src = _write_envelope(spark, sf_dir)
    out, ck = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-ck")
    valid = etl.clean_events(SRC.read_event_files_stream(spark, src))
    unique = deduplicate_stream(with_event_watermark(valid))
    _run_available_now(unique.writeStream.outputMode("append").format("parquet").option("path", out)
                       .option("checkpointLocation", ck).trigger(availableNow=True).start())
    return comparable(SRC.read_parquet(spark, out))


def q_str3_30s(spark, sf_dir):
    return comparable(window_aggregate(etl.unique_events(envelope(spark, sf_dir)), "30 seconds"))


def _stream_windows(spark, sources: list[str], within_watermark=True, pre_dedup=True) -> DataFrame:
    out, ck = scratch_path(spark, "windows-out"), scratch_path(spark, "windows-ck")
    for src in sources:   # each run resumes from the same checkpoint
        stream = stream_windows(SRC.read_event_files_stream(spark, src), within_watermark=within_watermark,
                                pre_dedup=pre_dedup)
        _run_available_now(write_windows_stream(stream, out, ck, available_now=True))
    return comparable(SRC.read_parquet(spark, out).select(*C.WINDOW_COLUMNS))


def q_str4_snk1(spark, sf_dir):
    return _stream_windows(spark, [_write_envelope(spark, sf_dir)])


def q_str4_dense(spark, sf_dir):
    return _stream_windows(spark, [_write_envelope(spark, sf_dir, dense_envelope)])


def q_str2_late_copy(spark, sf_dir):
    """Days 1-15 arrive and set the watermark. Then the other days arrive, a
    tenth of the rows preceded in the same file by a copy 20 days older: that
    copy is late and dropped, and must not take the on-time row with it."""
    ev = events(spark, sf_dir)
    src = scratch_path(spark, "envelope-late-copies")
    out, ck = scratch_path(spark, "late-copy-out"), scratch_path(spark, "late-copy-ck")
    day = F.to_date("ts")
    later = ev.filter(day > F.lit("2024-01-15"))
    older = (later.filter(F.col("event_id") % 10 == 5)
             .withColumn("ts", F.col("ts") - F.expr("INTERVAL 20 DAYS")))
    second = build_envelope(later).unionByName(build_envelope(older, with_duplicates=False))
    parts = [build_envelope(ev.filter(day <= F.lit("2024-01-15"))),
             second.repartition(8, "offset").sortWithinPartitions("offset", "timestamp")]
    for part in parts:
        part.write.mode("append").parquet(src)
        valid = etl.clean_events(SRC.read_event_files_stream(spark, src))
        _run_available_now(deduplicate_stream(with_event_watermark(valid)).writeStream.outputMode("append")
                           .format("parquet").option("path", out).option("checkpointLocation", ck)
                           .trigger(availableNow=True).start())
    return comparable(SRC.read_parquet(spark, out))


def q_str4_unbounded_dedup(spark, sf_dir):
    return _stream_windows(spark, [_write_envelope(spark, sf_dir)], within_watermark=False)


def q_str2_pre_dedup(spark, sf_dir):
    return _stream_windows(spark, [_write_envelope(spark, sf_dir)], pre_dedup=True)


def q_str2_no_pre_dedup(spark, sf_dir):
    return _stream_windows(spark, [_write_envelope(spark, sf_dir)], pre_dedup=False)


def q_str8_resume(spark, sf_dir):
    """Two runs over one checkpoint: days 1-15 arrive, the query stops, the
    rest arrives in the same folder, the query restarts and resumes."""
    env = envelope(spark, sf_dir)
    src = scratch_path(spark, "envelope-arrivals")
    out, ck = scratch_path(spark, "resume-out"), scratch_path(spark, "resume-ck")
    day = F.to_date("timestamp")
    for part in (day <= F.lit("2024-01-15"), day > F.lit("2024-01-15")):
        env.filter(part).write.mode("append").parquet(src)
        stream = stream_windows(SRC.read_event_files_stream(spark, src))
        _run_available_now(write_windows_stream(stream, out, ck, available_now=True))
    return comparable(SRC.read_parquet(spark, out).select(*C.WINDOW_COLUMNS))


def q_str5_late_arrivals(spark, sf_dir):
    """Days 3-30 arrive, then days 1-2 arrive in a later run over the same
    checkpoint. By then the watermark is at the end of day 30, so every held
    back row is late and dropped: the output holds only days 3-30."""
    env = envelope(spark, sf_dir)
    src = scratch_path(spark, "envelope-late")
    out, ck = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    day = F.to_date("timestamp")
    for part in (day > F.lit(LATE_SPLIT_DAY), day <= F.lit(LATE_SPLIT_DAY)):
        env.filter(part).write.mode("append").parquet(src)
        stream = stream_windows(SRC.read_event_files_stream(spark, src))
        _run_available_now(write_windows_stream(stream, out, ck, available_now=True))
    return comparable(SRC.read_parquet(spark, out).select(*C.WINDOW_COLUMNS))


def q_str5_dropped(spark, sf_dir):
    """As ``q_str5_late_arrivals``: how many rows the watermark dropped, over all batches of both runs. Without the
    pre-dedup, so that every late row reaches the operator that counts it."""
    env = envelope(spark, sf_dir)
    src = scratch_path(spark, "envelope-dropped")
    out, ck = scratch_path(spark, "dropped-out"), scratch_path(spark, "dropped-ck")
    day = F.to_date("timestamp")
    with ProgressLog(spark) as log:
        for part in (day > F.lit(LATE_SPLIT_DAY), day <= F.lit(LATE_SPLIT_DAY)):
            env.filter(part).write.mode("append").parquet(src)
            stream = stream_windows(SRC.read_event_files_stream(spark, src), pre_dedup=False)
            log.wait(write_windows_stream(stream, out, ck, available_now=True))
        return log.rows().agg(F.sum("rows_dropped").alias("rows_dropped"))


def _two_arrivals(spark, sf_dir, start, source=envelope) -> None:
    """Days 1-15 arrive and a query runs, then the others and it resumes; ``start(stream)`` starts it."""
    env = source(spark, sf_dir)
    src = scratch_path(spark, "envelope-two")
    day = F.to_date("timestamp")
    for part in (day <= F.lit("2024-01-15"), day > F.lit("2024-01-15")):
        env.filter(part).write.mode("append").parquet(src)
        _run_available_now(start(stream_windows(SRC.read_event_files_stream(spark, src))))


def q_str6_latest(spark, sf_dir):
    """Update mode merged by batch number: the latest state of every window, open ones too."""
    table, ck = scratch_path(spark, "latest"), scratch_path(spark, "latest-ck")
    _two_arrivals(spark, sf_dir, lambda w: upsert.write_latest_windows(w, table, ck, available_now=True))
    upsert.fold(spark, table)
    return comparable(upsert.latest(spark, table).select(*C.WINDOW_COLUMNS))


def _dense_state(spark, sf_dir) -> str:
    """The checkpoint of a stopped stream over dense events."""
    out, ck = scratch_path(spark, "state-out"), scratch_path(spark, "state-ck")
    stream = stream_windows(SRC.read_event_files_stream(spark, _write_envelope(spark, sf_dir, dense_envelope)))
    _run_available_now(write_windows_stream(stream, out, ck, available_now=True))
    return ck


def q_str2_state(spark, sf_dir):
    """Keys that the de-duplication still holds."""
    return state.state_rows(spark, _dense_state(spark, sf_dir), state.DEDUP).select("event_id", "device_id")


def q_str4_state(spark, sf_dir):
    """Windows that the aggregate still holds."""
    rows = state.state_rows(spark, _dense_state(spark, sf_dir), state.WINDOWS)
    return comparable(rows.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                                  "device_id", "device_type"))


def q_snk1_compacted(spark, sf_dir):
    """Compacted after the first run; the second run's files are read beside the generation."""
    out, ck, to = (scratch_path(spark, f"compact-{n}") for n in ("out", "ck", "to"))

    def start(windows):
        compaction.children(spark, out, "_spark_metadata") and compaction.compact(spark, out, to, STREAM_PARTITIONS)
        return write_windows_stream(windows, out, ck, available_now=True)

    _two_arrivals(spark, sf_dir, start)
    return comparable(compaction.read_compacted(spark, out, to).select(*C.WINDOW_COLUMNS))


#: Bytes of a pack in the registered compaction.
PACK_BYTES = 64 << 10


def q_snk1_file_bound(spark, sf_dir):
    """Rows of each directory after a compaction, and whether its files are at most bytes / pack + 1."""
    out, ck, to = (scratch_path(spark, f"bound-{n}") for n in ("out", "ck", "to"))
    _two_arrivals(spark, sf_dir, lambda w: write_windows_stream(w, out, ck, available_now=True))
    sizes = (compaction.committed_files(spark, out).groupBy("directory").agg(F.sum("size").alias("bytes"))
             .select(F.regexp_extract("directory", "device_type=([^/]+)", 1).alias("device_type"),
                     F.to_date(F.regexp_extract("directory", "event_date=([^/]+)", 1)).alias("event_date"), "bytes"))
    compaction.compact(spark, out, to, STREAM_PARTITIONS, PACK_BYTES)
    after = compaction.read_compacted(spark, out, to).groupBy("device_type", "event_date").agg(
        F.count("*").alias("row_count"), F.countDistinct("_metadata.file_path").alias("files"))
    return after.join(sizes, ["device_type", "event_date"], "left").select(
        "device_type", "event_date", "row_count",
        F.coalesce(F.col("files") <= F.floor(F.col("bytes") / PACK_BYTES) + 1, F.lit(False)).alias("within_bound"))


# --- quality -------------------------------------------------------------------------

def q_dq1(spark, sf_dir):
    return Q.check_columns(windows(spark, sf_dir))


def q_dq2(spark, sf_dir):
    return Q.null_counts(windows(spark, sf_dir))


def q_dq3(spark, sf_dir):
    return Q.check_non_empty(windows(spark, sf_dir))


def q_dq4(spark, sf_dir):
    return comparable(Q.quality_report(windows(spark, sf_dir)))


def _written_windows(spark, sf_dir) -> str:
    path = scratch_path(spark, "windows-table")
    write_windows(windows(spark, sf_dir), path)
    return path


def q_dq5(spark, sf_dir):
    return Q.check_partitions(SRC.read_parquet(spark, _written_windows(spark, sf_dir)))


def q_dq6(spark, sf_dir):
    path = scratch_path(spark, "report-csv")
    write_report(report(spark, sf_dir), path, "csv")
    return comparable(Q.validate_report(SRC.read_report_csv(spark, path, typed=False)))


def q_dq7(spark, sf_dir):
    parsed = TR.parse_payload(TR.project_envelope(envelope(spark, sf_dir)))
    return Q.contract_violation_counts(parsed)


def q_dq7_schema(spark, sf_dir):
    """The rules compiled from the schema document in a file, on payloads with missing keys, nulls and wrong types."""
    path = scratch_path(spark, "contract")
    spark.createDataFrame([(json.dumps(schemas.event_contract(), indent=1),)], "value string").coalesce(1).write.text(path)
    raw_text = TR.project_envelope(with_broken_payloads(envelope(spark, sf_dir)))
    return contract.contract_counts(raw_text, contract.load_contract(spark, path))


def _faulty_windows(spark, sf_dir) -> DataFrame:
    """The window table without its cities and without event_count, one column more, NULL types where the device's
    number ends in 7."""
    win = windows(spark, sf_dir)
    return (win.drop("city", "event_count").withColumn("note", F.lit("x"))
            .withColumn("device_type", F.when(~F.col("device_id").endswith("7"), F.col("device_type"))))


def q_dq1_faulty(spark, sf_dir):
    return Q.check_columns(_faulty_windows(spark, sf_dir))


def q_dq2_faulty(spark, sf_dir):
    return Q.null_counts(_faulty_windows(spark, sf_dir).withColumn("event_count", F.lit(1)))


def q_dq5_faulty(spark, sf_dir):
    """Types with an escaped name, NULL types, and a day of rows written below another type's directory and beside all."""
    from functools import reduce
    win = windows(spark, sf_dir).withColumn("device_type", F.when(F.col("device_type") == "click", "a/b: 50%+")
                                            .when(F.col("device_type") != "view", F.col("device_type")))
    path = scratch_path(spark, "windows-faulty")
    day = F.to_date("window_start")
    kept = win.withColumn("stored", F.col("device_type"))
    kept.filter(day > F.lit("2024-01-02")).write.partitionBy("device_type").parquet(path)
    kept.filter(day == F.lit("2024-01-01")).drop("device_type").write.parquet(f"{path}/device_type=wrong")
    kept.filter(day == F.lit("2024-01-02")).drop("device_type").write.parquet(f"{path}-beside")
    parts = [spark.read.parquet(*[p]).withColumn("device_type", F.col("stored")) for p in (path, f"{path}-beside")]
    return reduce(DataFrame.unionAll, [Q.check_partitions(p).withColumn("place", F.lit(n))
                                       for n, p in zip(("table", "beside"), parts)])


def q_dq6_faulty(spark, sf_dir):
    """A report with its columns in another order, a NaN percentile on every third day of the month and a blank type
    on every fifth, read from CSV."""
    path = scratch_path(spark, "report-faulty")
    day = F.dayofmonth("event_date")
    rows = report(spark, sf_dir).withColumn("percentile_95", F.when(day % 3 == 0, F.lit(float("nan"))).otherwise(F.col("percentile_95")))
    rows = rows.withColumn("device_type", F.when(day % 5 == 0, F.lit(" ")).otherwise(F.col("device_type")))
    write_report(rows.select(*reversed(C.REPORT_COLUMNS)), path, "csv")
    return comparable(Q.validate_report(SRC.read_report_csv(spark, path, typed=False)))


def q_dq6_missing(spark, sf_dir):
    """The file check on a report folder that is there and on one that is not."""
    from devpulse.plans.validation import validate_report_file
    path = scratch_path(spark, "report-there")
    write_report(report(spark, sf_dir), path, "csv")
    there, gone = validate_report_file(spark, path), validate_report_file(spark, f"{path}-gone")
    return (there.where("check = 'file_exists'").withColumn("file", F.lit("there"))
            .unionByName(gone.withColumn("file", F.lit("gone"))).select("file", "check", "status"))


def q_dq8(spark, sf_dir):
    inv = Q.storage_inventory(spark, _written_windows(spark, sf_dir))
    return Q.inventory_summary(inv).select("device_type", "partitions")


def q_dq10(spark, sf_dir):
    return Q.reject_reason_counts(flat(spark, sf_dir, keep_corrupt=True))


def q_dq11(spark, sf_dir):
    win = windows(spark, sf_dir)
    path = scratch_path(spark, "windows-table")
    day = F.to_date("window_start")
    write_windows(win.filter(day <= F.lit("2024-01-15")), path)
    before = Q.storage_inventory(spark, path)
    before = SRC.read_parquet(spark, _snapshot(before))
    write_windows(win.filter(day > F.lit("2024-01-15")), path)
    new = Q.inventory_delta(before, Q.storage_inventory(spark, path))
    return Q.inventory_summary(new).select("device_type", F.col("partitions").alias("new_partitions"))


def q_store_validation(spark, sf_dir):
    from devpulse.plans.validation import validate_window_store
    return validate_window_store(spark, _written_windows(spark, sf_dir))


def _snapshot(inventory: DataFrame) -> str:
    """Persist a listing so later writes do not change it."""
    path = scratch_path(inventory.sparkSession, "inventory")
    inventory.write.parquet(path)
    return path


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "SRC2_file_stream_envelope": q_src2,
        "SRC2_PRJ1_stream_payload_leaves": q_src2_payload,
        "SRC3_read_parquet": q_src3,
        "SRC4_read_json_events": q_src4,
        "SRC5_read_any_json_fallback": q_src5,
        "SNK3_SRC6_report_csv_roundtrip": q_snk3_src6,
        "SNK4_report_parquet_roundtrip": q_snk4,
        "PRJ1_project_envelope": q_prj1,
        "PRJ2_parse_payload": q_prj2,
        "PRJ3_flatten_event": q_prj3,
        "PRJ4_parse_event_time": q_prj4,
        "PRJ5_prepare_raw": q_prj5_raw,
        "PRJ5_prepare_aggregated": q_prj5_aggregated,
        "PRJ6_event_date": q_prj6,
        "FLT1_drop_unparsed": q_flt1,
        "FLT1_drop_null_and_empty_payloads": q_flt1_missing,
        "FLT2_valid_identity": _flt(TR.valid_identity),
        "FLT3_valid_duration": _flt(TR.valid_duration),
        "FLT4_valid_battery": _flt(TR.valid_battery),
        "FLT5_valid_signal": _flt(TR.valid_signal),
        "FLT6_valid_coordinates": _flt(TR.valid_coordinates),
        "FLT7_filter_valid_records": q_flt7,
        "FLT8_positive_events": q_flt8,
        "FLT8_positive_events_mixed": q_flt8_mixed,
        "FLT9_within_sigma": q_flt9,
        "FLT10_min_population": q_flt10,
        "JOIN1_attach_group_stats": q_join1,
        "JOIN2_restrict_to_groups": q_join2,
        "JOIN3_salted_join": q_join3,
        "JOIN3_heavy_keys_join": q_join3_heavy,
        "AGG1_PRJ7_window_aggregate": q_agg1,
        "AGG1_AGG2_dense_windows": q_agg1_dense,
        "AGG2_first_by_time": q_agg2,
        "AGG3_daily_stats": q_agg3,
        "AGG3_daily_stats_events_population": q_agg3_events,
        "AGG4_SRT1_percentile_report": q_agg4,
        "AGG4_percentile_report_approx_method": q_agg4_approx,
        "AGG4_two_level_sketch_rank_error": q_agg4_rank_error,
        "AGG4_percentile_report_events_population": q_agg4_events,
        "AGG4_percentile_report_aggregated_input": q_agg4_aggregated,
        "AGG4_percentile_report_two_joins": q_agg4_two_joins,
        "AGG5_exact_percentile_disc": q_agg5_disc,
        "AGG5_exact_percentile_cont": q_agg5_cont,
        "AGG5_SRT1_percentile_report_exact_method": q_agg5_report_method,
        "AGG6_report_summary": q_agg6,
        "AGG7_event_count_stats": q_agg7,
        "AGG7_dense_event_count_stats": q_agg7_dense,
        "AGG8_type_distribution": q_agg8,
        "AGG9_distinct_types": q_agg9,
        "AGG10_row_count": q_agg10,
        "LIM1_top_report_rows": q_lim1,
        "STR2_dedup_batch": q_str2_batch,
        "STR2_late_copy_then_on_time_copy": q_str2_late_copy,
        "STR2_dedup_within_watermark_stream": q_str2_stream,
        "STR3_tumbling_window_30s": q_str3_30s,
        "STR4_SNK1_stream_windows": q_str4_snk1,
        "STR4_dense_stream_windows": q_str4_dense,
        "STR4_stream_windows_unbounded_dedup": q_str4_unbounded_dedup,
        "STR2_STR4_stream_windows_pre_dedup": q_str2_pre_dedup,
        "STR2_STR4_stream_windows_no_pre_dedup": q_str2_no_pre_dedup,
        "STR8_resume_from_checkpoint": q_str8_resume,
        "STR5_late_arrivals_dropped": q_str5_late_arrivals,
        "STR5_STR7_rows_dropped_over_all_batches": q_str5_dropped,
        "STR6_update_mode_latest_windows": q_str6_latest,
        "STR1_STR2_keys_left_in_state": q_str2_state,
        "STR1_STR4_windows_left_in_state": q_str4_state,
        "SNK1_compacted_windows": q_snk1_compacted,
        "SNK1_compaction_file_bound": q_snk1_file_bound,
        "DQ1_check_columns": q_dq1,
        "DQ2_null_counts": q_dq2,
        "DQ3_check_non_empty": q_dq3,
        "DQ4_quality_report": q_dq4,
        "DQ5_check_partitions": q_dq5,
        "DQ6_validate_report": q_dq6,
        "DQ7_contract_violations": q_dq7,
        "DQ7_contract_from_schema_file": q_dq7_schema,
        "DQ1_check_columns_faulty": q_dq1_faulty,
        "DQ2_null_counts_faulty": q_dq2_faulty,
        "DQ5_check_partitions_faulty": q_dq5_faulty,
        "DQ6_validate_report_faulty": q_dq6_faulty,
        "DQ6_report_file_missing": q_dq6_missing,
        "DQ8_storage_inventory": q_dq8,
        "DQ10_reject_reasons": q_dq10,
        "DQ11_inventory_delta": q_dq11,
        "DQ1_DQ4_DQ5_window_store_validation": q_store_validation,
    }
