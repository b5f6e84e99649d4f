"""De-duplication and the tumbling-window aggregate (batch)."""

import datetime as dt

from pyspark.sql import functions as F

from devpulse.operators.windows import deduplicate, window_aggregate

WIN_IN = ("event_id bigint, device_id string, device_type string, event_timestamp timestamp, "
          "event_duration double, battery_level int, signal_strength int, city string, country string, "
          "firmware_version string")


def test_dedup_by_both_keys(spark):
    t = dt.datetime(2023, 6, 2, 21, 4)
    df = spark.createDataFrame([(5, "a", t), (5, "a", t), (5, "b", t), (6, "a", t), (6, "a", t)],
                               "event_id bigint, device_id string, event_timestamp timestamp")
    assert deduplicate(df).count() == 3


def test_dedup_keeps_first_arrival(spark):
    t = dt.datetime(2024, 1, 15, 10, 30)
    rows = [(1, "d", t, 5, "late copy"), (1, "d", t, 2, "first"), (1, "d", t, 9, "later")]
    df = spark.createDataFrame(rows, "event_id bigint, device_id string, event_timestamp timestamp, "
                                     "kafka_offset bigint, note string")
    df = df.withColumn("kafka_timestamp", F.lit(t)).withColumn("kafka_partition", F.lit(0))
    assert deduplicate(df).first().note == "first"


def test_window_measures(spark):
    d = dt.datetime
    rows = [(3, "p", "thermo", d(2023, 6, 2, 21, 4, 41), 8.0, 20, -10, "late", "L", "2"),
            (1, "p", "thermo", d(2023, 6, 2, 21, 4, 7), 1.0, 60, -40, None, "F", "1"),
            (2, "p", "thermo", d(2023, 6, 2, 21, 4, 19), 3.0, 40, -100, "mid", "M", "3"),
            (4, "p", "thermo", d(2023, 6, 2, 21, 5, 0), 5.0, 50, -50, "next", "N", "4")]
    out = {str(r.window_start): r for r in window_aggregate(spark.createDataFrame(rows, WIN_IN)).collect()}
    assert set(out) == {"2023-06-02 21:04:00", "2023-06-02 21:05:00"}
    r = out["2023-06-02 21:04:00"]
    assert (r.event_count, r.avg_duration, r.max_duration, r.min_duration) == (3, 4.0, 8.0, 1.0)
    assert (r.avg_battery_level, r.min_battery_level, r.avg_signal_strength, r.min_signal_strength) == \
        (40.0, 20, -50.0, -100)
    assert str(r.window_end) == "2023-06-02 21:05:00"
    # AGG2: the earliest row's descriptive fields, whatever the input order
    assert (r.city, r.country, r.firmware_version) == (None, "F", "1")
    assert str(r.last_event_time) == "2023-06-02 21:04:41"


def test_first_by_time_is_order_independent(spark):
    d = dt.datetime
    rows = [(i, "dev", "t", d(2024, 1, 1, 0, 0, 59 - i), 1.0, 1, -1, f"c{i}", "x", "f") for i in range(50)]
    a = window_aggregate(spark.createDataFrame(rows, WIN_IN).repartition(7)).first().city
    b = window_aggregate(spark.createDataFrame(list(reversed(rows)), WIN_IN).repartition(3)).first().city
    assert a == b == "c49"


def test_windows_are_half_open(spark):
    d = dt.datetime
    rows = [(1, "dev", "t", d(2024, 1, 1, 0, 0, 59, 999999), 1.0, 1, -1, "c", "x", "f"),
            (2, "dev", "t", d(2024, 1, 1, 0, 1, 0), 1.0, 1, -1, "c", "x", "f")]
    assert window_aggregate(spark.createDataFrame(rows, WIN_IN)).count() == 2
    assert window_aggregate(spark.createDataFrame(rows, WIN_IN), "2 minutes").count() == 1


def test_batch_chain_collapses_keys_before_every_shuffle(spark):
    # the de-dup shuffle sits between two group limits, the window shuffle between
    # two aggregates, so a key with millions of copies (or a device flooding a
    # window) is collapsed before it moves
    from devpulse.plans import etl
    from devpulse.sources.fixtures import build_envelope
    from devpulse.sources.tables import load_table
    w = etl.window_table(build_envelope(load_table(spark, "/root/testdata/sf0.001", "events")))
    plan = w.sparkSession._jvm.PythonSQLUtils.explainString(w._jdf.queryExecution(), "simple")
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    for i, step in zip(exchanges, ("Aggregate", "WindowGroupLimit")):
        assert step in lines[i - 1] or step in lines[i - 2]      # final side (maybe via Sort)
        assert step in lines[i + 1] or step in lines[i + 2]      # map side
