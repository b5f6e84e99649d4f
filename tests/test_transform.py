"""Parsing, flattening, event-time parsing and the validity filters."""

import json

import pytest
from pyspark.sql import functions as F

from devpulse import schemas
from devpulse.functions.predicates import reject_reasons_expr
from devpulse.operators import transform as TR
from devpulse.plans.etl import reject_reasons, split_by_validity

SAMPLE = {
    "event_id": 9071, "device_id": "dev_7", "device_type": "thermo",
    "event_time": "2023-06-02T21:04:09.000417+00:00", "event_duration": 17.25,
    "location": {"latitude": -33.45, "longitude": 151.2, "city": "Gosford", "country": "Australia"},
    "metadata": {"firmware_version": "0.9.1", "battery_level": 31, "signal_strength": -48},
}


def envelope(spark, payloads):
    rows = [(b"k", None if p is None else p.encode(), "input_events", 0, i, None, 0)
            for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def test_sample_event_parses(spark):
    flat = TR.parse_events(envelope(spark, [json.dumps(SAMPLE)])).collect()
    assert len(flat) == 1
    r = flat[0]
    assert r.event_id == 9071 and r.device_id == "dev_7" and r.city == "Gosford"
    assert r.battery_level == 31 and r.signal_strength == -48
    assert str(r.event_timestamp) == "2023-06-02 21:04:09.000417"
    assert TR.filter_valid_records(TR.parse_events(envelope(spark, [json.dumps(SAMPLE)]))).count() == 1


def test_invalid_sample_is_dropped_with_reasons(spark):
    bad = json.loads(json.dumps(SAMPLE))
    bad.update(event_id=None, event_duration=100.0)
    bad["location"]["longitude"] = -180.5
    bad["metadata"].update(battery_level=-1, signal_strength=3)
    flat = TR.parse_events(envelope(spark, [json.dumps(bad)]), keep_corrupt=True)
    assert TR.filter_valid_records(flat).count() == 0
    reasons = reject_reasons(flat).first().reject_reasons
    assert reasons == ["missing_event_id", "bad_duration", "bad_battery_level", "bad_signal_strength",
                       "bad_coordinates"]


def test_trap2_malformed_json_is_a_struct_of_nulls(spark):
    env = envelope(spark, ["invalid json", "", None, "[1, 2]", json.dumps(SAMPLE)])
    parsed = TR.parse_payload(TR.project_envelope(env))
    kept = TR.drop_unparsed(parsed)
    # only NULL and '' give a NULL struct; malformed text survives FLT1 and dies at FLT2
    assert kept.count() == 3
    flat = TR.parse_events(env, keep_corrupt=True)
    assert flat.filter(F.col("_corrupt_record").isNotNull()).count() == 2
    assert TR.filter_valid_records(flat).count() == 1


def test_trap1_event_time_shapes_with_ansi_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    texts = ["2022-08-27T19:03:58.407219+00:00", "2022-08-27T19:03:58+00:00", "2022-08-27T19:03:58.407219Z",
             "2022-08-27T19:03:58Z", "2022-08-27T21:03:58.407+02:00", "2022-08-27T19:03:58.1Z", "garbage", None]
    df = spark.createDataFrame([(t,) for t in texts], "event_time_str string")
    out = [r.event_timestamp for r in TR.parse_event_time(df).collect()]
    assert [str(x) for x in out[:6]] == ["2022-08-27 19:03:58.407219", "2022-08-27 19:03:58",
                                         "2022-08-27 19:03:58.407219", "2022-08-27 19:03:58",
                                         "2022-08-27 19:03:58.407000", "2022-08-27 19:03:58.100000"]
    assert out[6] is None and out[7] is None


FLAT_COLS = "event_id bigint, device_id string, device_type string, event_timestamp timestamp, " \
            "event_duration double, battery_level int, signal_strength int, latitude double, longitude double"


def flat_rows(spark, rows):
    import datetime as dt
    ts = dt.datetime(2023, 11, 4, 6, 17)
    full = [(i, "dev_1", "sensor_A", ts, d, b, s, la, lo) for i, d, b, s, la, lo in rows]
    return spark.createDataFrame(full, FLAT_COLS)


def test_a_row_stays_only_if_every_measure_is_valid(spark):
    """All sixteen mixtures of one good and one bad value for duration, battery, signal and latitude."""
    from itertools import product
    values = [(12.75, 130.0), (61, -4), (-33, 9), (-17.5, 91.25)]
    cases = [(i, *(v[bad] for v, bad in zip(values, mix)), 8.0) for i, mix in enumerate(product((0, 1), repeat=4))]
    assert [r.event_id for r in TR.filter_valid_records(flat_rows(spark, cases)).collect()] == [0]


@pytest.mark.parametrize("op,field,values,expected", [
    (TR.valid_duration, 1, [-0.0, 0.0, 0.001, 99.999, 100.0, None], [False, False, True, True, False, False]),
    (TR.valid_battery, 2, [-1, 0, 100, 101, None], [False, True, True, False, False]),
    (TR.valid_signal, 3, [-121, -120, 0, 1, None], [False, True, True, False, False]),
    (TR.valid_coordinates, 4, [-90.0001, -90.0, 90.0, 90.0001, None], [False, True, True, False, False]),
    (TR.valid_coordinates, 5, [-180.0001, -180.0, 180.0, 180.0001, None], [False, True, True, False, False]),
])
def test_predicate_boundaries(spark, op, field, values, expected):
    base = [1, 2.5, 50, -60, 10.0, 10.0]
    rows = []
    for i, v in enumerate(values):
        r = list(base)
        r[0] = i
        r[field] = v
        rows.append(tuple(r))
    kept = {r.event_id for r in op(flat_rows(spark, rows)).collect()}
    assert [i in kept for i in range(len(values))] == expected


def test_identity_nulls(spark):
    import datetime as dt
    ts = dt.datetime(2024, 1, 15)
    rows = [(1, "d", "t", ts), (None, "d", "t", ts), (3, None, "t", ts), (4, "d", None, ts), (5, "d", "t", None)]
    df = spark.createDataFrame(rows, "event_id bigint, device_id string, device_type string, event_timestamp timestamp")
    assert [r.event_id for r in TR.valid_identity(df).collect()] == [1]


def test_reasons_agree_with_filter(spark):
    from devpulse.sources.fixtures import build_envelope
    from devpulse.sources.tables import load_table
    flat = TR.parse_events(build_envelope(load_table(spark, "/root/testdata/sf0.001", "events")), keep_corrupt=True)
    accepted, rejected = split_by_validity(flat)
    assert accepted.count() == TR.filter_valid_records(flat).count()
    assert accepted.count() + rejected.count() == flat.count()
    assert flat.select(reject_reasons_expr(True).alias("r")).filter(F.size("r") == 0).count() == accepted.count()


def test_prepare_events_modes(spark):
    import datetime as dt
    raw = spark.createDataFrame([(2.5, "sensor_A", dt.datetime(2024, 1, 15, 1), "dev_1")],
                                "event_duration double, device_type string, event_timestamp timestamp, device_id string")
    assert TR.prepare_events(raw).columns == ["event_duration", "device_type", "timestamp", "device_id"]
    # TRAP6: producer-shaped input carries only event_time text
    text = spark.createDataFrame([(2.5, "sensor_A", "2024-01-15T01:00:00+00:00", "dev_1")],
                                 "event_duration double, device_type string, event_time string, device_id string")
    r = TR.with_event_date(TR.prepare_events(text)).first()
    assert str(r.event_date) == "2024-01-15"
    agg = spark.createDataFrame([(2.0, "sensor_A", dt.datetime(2024, 1, 15, 1), "dev_1")],
                                "avg_duration double, device_type string, window_start timestamp, device_id string")
    assert TR.prepare_events(agg).first().event_duration == 2.0
    with pytest.raises(ValueError):
        TR.prepare_events(spark.createDataFrame([(1,)], "x int"))


def test_guarded_event_time_parse_equals_plain_chain(spark):
    # the library skips patterns that cannot match; the plain chain tries all four in order
    import itertools
    from devpulse.constants import EVENT_TIME_FORMATS
    from devpulse.functions.time import parse_event_time_expr
    dates = ["2024-01-15", "2024-1-15", "2024-02-30", "2024-13-01"]
    seps = ["T", "t", " "]
    times = ["10:20:30", "10:20", "25:00:00"]
    fractions = ["", ".1", ".123", ".123456", ".1234567", ".", ".12a"]
    zones = ["", "Z", "z", "+02:00", "-05:30", "+0200", "+02", " UTC", "+02:00Z", "GMT"]
    tails = ["", "x", " "]
    texts = ["".join(parts) for parts in itertools.product(dates, seps, times, fractions, zones, tails)]
    texts += ["", "not a time", ".", "Z", "z", "2024", "2024-01-15", ".2024-01-15T10:20:30Z", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    plain = F.coalesce(*[F.try_to_timestamp(t, F.lit(fmt)) for fmt in EVENT_TIME_FORMATS], F.try_to_timestamp(t))
    both = df.select("t", plain.alias("plain"), parse_event_time_expr(t).alias("guarded"))
    diff = both.filter(~F.col("plain").eqNullSafe(F.col("guarded"))).collect()
    assert not diff, diff[:5]
    assert both.filter(F.col("plain").isNotNull()).count() > 100      # the corpus does parse
