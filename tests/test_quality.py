"""Data-quality operators."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from devpulse import constants as C
from devpulse.operators import quality as Q
from devpulse.operators import transform as TR
from devpulse.plans import etl
from devpulse.session import scratch_path
from devpulse.sinks import write_report, write_windows
from devpulse.sources.files import read_parquet, read_report_csv
from devpulse.sources.fixtures import build_envelope
from devpulse.sources.tables import load_table

SF001 = "/root/testdata/sf0.001"


def windows(spark):
    return etl.window_table(build_envelope(load_table(spark, SF001, "events")))


def status(df, key="check"):
    return {r[key]: r.status for r in df.collect()}


def test_check_columns_statuses(spark):
    w = windows(spark)
    assert set(status(Q.check_columns(w), "column_name").values()) == {"ok"}
    broken = w.drop("event_count", "city").withColumn("extra_col", F.lit(1))
    st = status(Q.check_columns(broken), "column_name")
    assert st["event_count"] == "fail" and st["city"] == "warn" and st["extra_col"] == "extra"
    r = {x.column_name: x for x in Q.check_columns(w).collect()}
    assert r["device_id"].row_count == w.count() and r["device_id"].null_count == 0
    assert r["event_count"].data_type == "bigint"


def test_null_counts_and_non_empty(spark):
    df = spark.createDataFrame([("a", None, 1), (None, None, 2)], "device_id string, device_type string, event_count bigint")
    assert {r.column_name: r.null_count for r in Q.null_counts(df).collect()} == \
        {"device_id": 1, "device_type": 2, "event_count": 0}
    assert status(Q.check_non_empty(df.limit(0)))["non_empty"] == "fail"
    assert status(Q.check_non_empty(df))["non_empty"] == "pass"


def test_quality_report_matches_direct_aggregates(spark):
    w = windows(spark)
    rep = {(r.check, r.scope): r.observed for r in Q.quality_report(w).collect()}
    stats = Q.event_count_stats(w).first()
    assert rep[("row_count", "all")] == stats.total_records
    assert abs(rep[("avg_event_count", "all")] - stats.avg_event_count) < 1e-12
    assert rep[("max_event_count", "all")] == stats.max_event_count
    dist = {r.device_type: r.row_count for r in Q.type_distribution(w).collect()}
    assert {s: v for (c, s), v in rep.items() if c == "type_count"} == dist
    assert Q.distinct_types(w).count() == len(dist) and Q.row_count(w).first().row_count == stats.total_records


SAMPLE_REPORT = [  # all valid, all totals >= 500
    ("thermo", "2023-06-02", "9.5", "4.25", "2.5", "700", "9"),
    ("thermo", "2023-06-03", "8.75", "4.0", "2.25", "640", "8"),
    ("camera", "2023-06-02", "61.0", "30.5", "12.5", "500", "7"),
    ("sensor_B", "2023-06-04", "0.5", "0.25", "0.125", "9001", "300"),
]
REPORT_TEXT = ", ".join(f"{c} string" for c in C.REPORT_COLUMNS)


def test_validate_report_sample_passes(spark):
    df = spark.createDataFrame(SAMPLE_REPORT, REPORT_TEXT)
    assert set(status(Q.validate_report(df)).values()) == {"pass"}


def test_validate_report_failures(spark):
    bad = SAMPLE_REPORT + [(" ", "2024-01-15", "1", "1", "1", "900", "3"),       # blank type
                           ("thermo", "2024-01-17", "0", "1", "1", "900", "3"),   # p95 not > 0
                           ("thermo", "2024-01-18", "1", "1", "1", "12.5", "3"),  # not an integer
                           ("thermo", "2024-01-19", "1", "1", "1", "499", "3")]   # valid, too few
    st = {r.check: r for r in Q.validate_report(spark.createDataFrame(bad, REPORT_TEXT)).collect()}
    assert st["data_valid"].status == "fail" and st["data_valid"].observed == 3
    assert st["min_events_check"].status == "fail" and st["min_events_check"].observed == 1
    empty = spark.createDataFrame([], REPORT_TEXT)
    assert status(Q.validate_report(empty))["has_data"] == "fail"
    assert status(Q.validate_report(spark.createDataFrame(SAMPLE_REPORT, REPORT_TEXT).drop("stddev_duration")))[
        "columns_match"] == "fail"


def test_report_csv_roundtrip(spark):
    df = spark.createDataFrame(SAMPLE_REPORT, REPORT_TEXT)
    typed = df.select([F.col(c).try_cast(t) for c, t in zip(
        C.REPORT_COLUMNS, ["string", "date", "double", "double", "double", "bigint", "bigint"])])
    path = scratch_path(spark, "t-csv")
    write_report(typed, path, "csv")
    back = read_report_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, typed.collect()))
    import glob
    assert len(glob.glob(f"{path}/part-*.csv")) == 1


def test_contract_rules(spark):
    from tests.test_transform import SAMPLE, envelope
    import json
    bad = json.loads(json.dumps(SAMPLE))
    bad.update(event_id=None, device_type="drone")
    bad["metadata"].update(battery_level=150)
    parsed = TR.parse_payload(TR.project_envelope(envelope(spark, [json.dumps(SAMPLE), json.dumps(bad), "nope"])))
    tagged = {r.kafka_offset: r.contract_violations for r in Q.validate_contract(parsed).collect()}
    assert tagged[0] == []
    assert tagged[1] == ["required:event_id", "enum:device_type", "range:battery_level"]
    assert tagged[2][0] == "malformed_json"
    counts = {r.rule: r.row_count for r in Q.contract_violation_counts(parsed).collect()}
    assert counts["required:event_id"] == 2 and counts["malformed_json"] == 1
    accepted, rejected = Q.split_contract(parsed)
    assert accepted.count() == 1 and rejected.count() == 2


def test_partitions_inventory_and_delta(spark):
    w = windows(spark)
    path = scratch_path(spark, "t-win")
    day = F.to_date("window_start")
    write_windows(w.filter(day <= F.lit("2024-01-15")), path)
    before_path = scratch_path(spark, "t-inv")
    Q.storage_inventory(spark, path).write.parquet(before_path)
    before = read_parquet(spark, before_path)
    write_windows(w.filter(day > F.lit("2024-01-15")), path)
    stored = read_parquet(spark, path)
    chk = Q.check_partitions(stored).first()
    assert chk.mismatched_rows == 0 and chk.rows_outside_partitions == 0
    assert chk.distinct_types == w.select("device_type").distinct().count()
    inv = Q.storage_inventory(spark, path)
    summary = {r.device_type: r for r in Q.inventory_summary(inv).collect()}
    want = {r.device_type: r.n for r in w.groupBy("device_type").agg(F.countDistinct(day).alias("n")).collect()}
    assert {k: v.partitions for k, v in summary.items()} == want
    assert all(v.files >= v.partitions and v.bytes > 0 for v in summary.values())
    new = Q.inventory_delta(before, inv)
    assert new.count() + before.count() == inv.count()
    assert stored.count() == w.count()


def test_store_checks_one_scan_equals_separate_checks(spark):
    path = scratch_path(spark, "t-store-fused")
    write_windows(windows(spark).drop("city"), path)      # a warn-level gap too
    df = read_parquet(spark, path)
    columns, quality, partitions = Q.store_checks(df)

    def rows(x):
        return sorted(tuple(r) for r in x.collect())
    assert rows(columns) == rows(Q.check_columns(df))
    assert rows(quality) == rows(Q.quality_report(df))
    assert rows(partitions) == rows(Q.check_partitions(df))
    # the folded tables read only the staged profile, never the store again
    plan = quality._jdf.queryExecution().executedPlan().toString()
    assert "store-profile" in plan and path not in plan


def _csv(spark, name, lines):
    path = scratch_path(spark, name)
    spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.text(path)
    return path


def test_report_csv_is_read_by_its_header(spark):
    order = ["mean_duration", "event_date", "device_type", "distinct_devices", "percentile_95", "total_events",
             "stddev_duration"]
    at = [C.REPORT_COLUMNS.index(c) for c in order]
    path = _csv(spark, "t-order", [",".join(order), *(",".join(r[i] for i in at) for r in SAMPLE_REPORT)])
    back = read_report_csv(spark, path)
    assert back.columns == C.REPORT_COLUMNS
    first = back.where("device_type = 'camera'").first()
    assert (str(first.event_date), first.percentile_95, first.mean_duration) == ("2023-06-02", 61.0, 30.5)
    assert set(status(Q.validate_report(read_report_csv(spark, path, typed=False))).values()) == {"pass"}


def test_report_file_checks_header_nan_and_existence(spark):
    from devpulse.plans.validation import validate_report_file
    wrong = _csv(spark, "t-wrong", ["a,b,c,d,e,f,g", ",".join(SAMPLE_REPORT[0])])
    assert status(validate_report_file(spark, wrong))["columns_match"] == "fail"
    head = ",".join(C.REPORT_COLUMNS)
    odd = _csv(spark, "t-odd", [head, "thermo,2023-06-02,NaN,1,1,900,3", ",2023-06-02,1,1,1,900,3",
                                "thermo,2023-06-02,1,1,1,12.5,3", "thermo,2023-06-02,1,1,1,900,3"])
    checks = {r.check: r for r in validate_report_file(spark, odd).collect()}
    assert checks["file_exists"].status == "pass" and checks["data_valid"].observed == 3
    missing = validate_report_file(spark, odd + "-none").collect()
    assert [(r.check, r.status) for r in missing] == [("file_exists", "fail")]


def test_partition_check_decodes_escaped_directories(spark):
    path = scratch_path(spark, "t-escaped")
    rows = [("sensor A:1", 1), ("100%", 2), ("a+b", 3), (None, 4), ("plain", 5)]
    df = spark.createDataFrame(rows, "device_type string, event_count bigint")
    df.withColumn("kept", F.col("device_type")).write.partitionBy("device_type").parquet(path)
    r = Q.check_partitions(spark.read.parquet(path)).first()
    assert (r.distinct_types, r.mismatched_rows, r.rows_outside_partitions) == (4, 0, 0)


@pytest.mark.parametrize("text,good", [("2024", False), ("10:30", False), ("2024-01-15", False),
                                       ("2023-06-02T21:04:09Z", True), ("2023-06-02T21:04:09.5+02:00", True)])
def test_contract_date_time(spark, text, good):
    from tests.test_transform import SAMPLE, envelope
    parsed = TR.parse_payload(TR.project_envelope(envelope(spark, [json.dumps(SAMPLE | {"event_time": text})])))
    assert ("format:event_time" in Q.validate_contract(parsed).first().contract_violations) != good


def test_time_alone_is_no_event_time(spark):
    from devpulse.functions.time import parse_event_time_expr
    df = spark.createDataFrame([("10:30",), ("T10:30:00",), ("2024-01-15 10:30:00",)], "t string")
    assert [r[0] is None for r in df.select(parse_event_time_expr(F.col("t"))).collect()] == [True, True, False]
