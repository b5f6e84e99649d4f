"""Two-level sketches, heavy keys, compaction, the update-mode table, state and progress, the compiled contract."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from devpulse import schemas
from devpulse.operators import contract, joins
from devpulse.operators.sketch_quantile import rank_error, two_level_quantile
from devpulse.plans import catalog
from devpulse.session import scratch_path
from devpulse.sources import files as SRC
from devpulse.streaming import compaction, state, upsert
from devpulse.streaming.etl import stream_windows
from devpulse.streaming.progress import ProgressLog
from devpulse.streaming.sinks import REFERENCE_PARTITIONS, STREAM_PARTITIONS, write_windows_stream
from tests.conftest import SF001


# --- AGG4: two-level sketch ---------------------------------------------------------

def test_small_groups_are_exact(spark):
    rng = random.Random(1)
    rows = [(f"g{i % 4}", rng.choice([None, 0.0, -0.0, rng.gauss(5, 2), 1e9])) for i in range(400)] + [("null", None), ("one", 3.5)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {r.g: r for r in two_level_quantile(df, ["g"], "x", 0.95, "q", deals=3).collect()}
    assert set(got) == {"g0", "g1", "g2", "g3", "one"}
    for g, r in got.items():
        xs = sorted(x for k, x in rows if k == g and x is not None)
        assert r.q == xs[int(np.ceil(0.95 * len(xs) - 1e-9)) - 1] and r["_rows"] == len(xs)
        assert np.isclose(r["_mean"], np.mean(xs))
        assert r["_stddev"] is None if len(xs) == 1 else np.isclose(r["_stddev"], np.std(xs, ddof=1))


def test_one_group_over_many_tasks(spark):
    n, k = 200_000, 400
    df = spark.range(n, numPartitions=40).select(F.lit("hot").alias("g"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("double").alias("x"))
    out = two_level_quantile(df, ["g"], "x", 0.95, "q", k, deals=6)
    q = out.first().q
    assert abs(df.where(F.col("x") <= q).count() / n - 0.95) <= 3 * rank_error(k)
    # First level: a row a (group, deal); no reducer of the first level sees more than the map tasks of its deal.
    tasks = df.select(F.spark_partition_id().alias("t")).distinct().select(F.pmod("t", F.lit(6)).alias("d")).groupBy("d").count()
    assert tasks.agg(F.max("count")).first()[0] == 7
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_deal" in plan and "kll_merge_agg_double" in plan and "percentile_approx" not in plan


# --- JOIN3: heavy keys ---------------------------------------------------------------

@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_heavy_key_join_equals_plain(spark, how):
    rows = [(None if i % 50 == 0 else 7 if i % 3 == 0 else i % 90, i) for i in range(2000)]
    big = spark.createDataFrame(rows, "k int, v int").repartition(5)
    small = spark.createDataFrame([(k, f"s{k}") for k in [*range(0, 60), 7, None]], "k int, s string")
    want = sorted(map(str, big.join(small, ["k"], how).collect()))
    assert sorted(map(str, joins.skew_join(big, small, ["k"], how, salts=4, share=0.1).collect())) == want


def test_only_heavy_keys_are_replicated(spark):
    big = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"))
    hot = joins.heavy_keys(big, ["k"], 0.1)
    assert hot == [big.where("k = 1").select(F.xxhash64("k")).first()[0]]
    assert joins.heavy_keys(big.limit(0), ["k"], 0.1) == []
    small = spark.range(1000).select(F.col("id").cast("long").alias("k"), F.lit("x").alias("s"))
    joined = joins.skew_join(big, small, ["k"], salts=8, share=0.1)
    assert joined.count() == 1000 and "_salt" not in joined.columns
    plan = joined._jdf.queryExecution().optimizedPlan()
    generates = [p for p in plan.toString().split("\n") if "Generate explode" in p]
    assert len(generates) == 1 and "CASE WHEN" in generates[0]
    is_hot = F.xxhash64("k").isin(hot)
    copies = small.select(F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(7))).otherwise(F.array(F.lit(0)))))
    assert copies.count() == 1000 + 7  # all keys salted: 8,000


# --- SNK1: compaction ------------------------------------------------------------------

def _stream(spark, src, out, ck, layout=STREAM_PARTITIONS):
    write_windows_stream(stream_windows(SRC.read_event_files_stream(spark, src)), out, ck, partition_by=layout,
                         available_now=True).awaitTermination()


def _files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


@pytest.mark.parametrize("layout", [STREAM_PARTITIONS, REFERENCE_PARTITIONS])
def test_compaction_keeps_rows_and_bounds_files(spark, layout):
    src = catalog._write_envelope(spark, SF001)
    out, ck, to = (scratch_path(spark, f"t-compact-{n}") for n in ("out", "ck", "to"))
    _stream(spark, src, out, ck, layout)
    want = sorted(map(str, spark.read.parquet(out).select("window_start", "device_id", "event_count").collect()))

    def got():
        return sorted(map(str, compaction.read_compacted(spark, out, to).select("window_start", "device_id", "event_count").collect()))

    assert got() == want  # no generation yet
    # A file of an unfinished batch, and the draft of a killed compaction: neither is read.
    stray = next(os.path.join(d, f) for d, _, names in os.walk(out) for f in names if f.endswith(".parquet"))
    with open(stray, "rb") as a, open(os.path.join(os.path.dirname(stray), "part-99999-stray.parquet"), "wb") as b:
        b.write(a.read())
    spark.range(3).write.parquet(f"{to}/_draft-killed/rows")
    assert got() == want
    gen = compaction.compact(spark, out, to, layout, 1 << 20)
    assert got() == want and [g.rsplit('/', 1)[1] for g in compaction.generations(spark, to)] == [gen.rsplit('/', 1)[1]]
    directories = {d for d, _, names in os.walk(out) if "_spark_metadata" not in d and any(f.endswith(".parquet") for f in names)}
    assert _files(f"{gen}/rows") == len(directories) <= _files(out)
    assert compaction.compact(spark, out, to, layout) is None  # nothing new
    assert got() == want


def test_packs_hold_about_the_target(spark):
    files = spark.createDataFrame([(f"d{i % 2}/f{i:03d}", 10 + i % 5, f"d{i % 2}") for i in range(100)],
                                  "path string, size long, directory string")
    got = compaction.packs(files, 50).join(files, ["path", "directory"]).groupBy("directory", "pack").agg(F.sum("size").alias("n"))
    rows = got.collect()
    assert all(r.n <= 50 + 14 for r in rows)
    for d in ("d0", "d1"):
        mine = [r.n for r in rows if r.directory == d]
        assert len(mine) <= sum(mine) // 50 + 1


def test_compaction_opens_only_the_named_files(spark):
    """The sink's log names the files, in odd directories too: none is looked up, and only those asked for are read."""
    src, path, ck = (scratch_path(spark, f"named-{n}") for n in ("src", "out", "ck"))
    spark.createDataFrame([(1, "a"), (2, "b=c d"), (3, "e'f%g\\h"), (4, "a"), (5, None)], "id long, kind string").write.parquet(src)
    (spark.readStream.schema("id long, kind string").parquet(src).repartition("kind").writeStream.format("parquet").partitionBy("kind")
     .trigger(availableNow=True).option("path", path).option("checkpointLocation", ck).start().awaitTermination())
    names = sorted(r.path for r in compaction.committed_files(spark, path).collect())
    seen = []
    for name in names:
        rows = compaction._rows(spark, path, [name])
        seen.append(sorted((r.id, r.kind) for r in rows.collect()))
        scan = rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        assert "MetadataLogFileIndex" in scan.toString() and scan.metrics().apply("numFiles").value() == 1
    assert sorted(map(str, seen)) == sorted(map(str, [[(1, "a"), (4, "a")], [(2, "b=c d")], [(3, "e'f%g\\h")], [(5, None)]]))
    assert compaction._rows(spark, path, names).count() == 5


# --- STR6: update mode -------------------------------------------------------------------

def test_replayed_batches_change_nothing(spark):
    table = scratch_path(spark, "t-latest")
    keys = ["k"]

    def batch(*rows):
        return spark.createDataFrame(rows, "k string, n int")

    assert upsert.merge_batch(batch(("a", 1), ("b", 1)), 0, table)
    assert upsert.merge_batch(batch(("a", 2)), 1, table)
    state_now = lambda: {r.k: r.n for r in upsert.latest(spark, table, keys).collect()}
    assert state_now() == {"a": 2, "b": 1}
    assert not upsert.merge_batch(batch(("a", 99)), 0, table) and state_now() == {"a": 2, "b": 1}
    base = upsert.fold(spark, table, keys)
    assert base.endswith("base-000000000001") and upsert.fold(spark, table, keys) is None and state_now() == {"a": 2, "b": 1}
    assert not upsert.merge_batch(batch(("b", 99)), 1, table)
    spark.range(1).write.parquet(f"{table}/_draft-killed")
    assert upsert.merge_batch(batch(("b", 3)), 2, table) and state_now() == {"a": 2, "b": 3}
    with pytest.raises(ValueError):
        upsert.latest(spark, scratch_path(spark, "t-none"))


# --- STR5, STR7: progress; STR1: state ------------------------------------------------------

def test_the_log_keeps_what_the_query_forgets(spark):
    src = catalog._write_envelope(spark, SF001, lambda s, d: catalog.envelope(s, d).repartition(6))
    out, ck = scratch_path(spark, "t-log-out"), scratch_path(spark, "t-log-ck")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with ProgressLog(spark) as log:
            stream = stream_windows(SRC.read_event_files_stream(spark, src, max_files_per_trigger=1))
            query = write_windows_stream(stream, out, ck, available_now=True)
            log.wait(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = log.rows()
    assert len(query.recentProgress) <= 2 < rows.select("batch").distinct().count()
    read = rows.select("batch", "input_rows").distinct().agg(F.sum("input_rows")).first()[0]
    assert read == spark.read.parquet(src).count()
    assert {r.name for r in rows.select("name").distinct().collect()} == {state.DEDUP, state.WINDOWS}
    held = rows.orderBy(F.desc("batch")).where(F.col("name") == state.WINDOWS).first().rows_in_state
    assert state.state_rows(spark, ck, state.WINDOWS).count() == held
    with pytest.raises(ValueError):
        state.state_rows(spark, ck, "noSuchOperator")


# --- DQ7: compiled contract -------------------------------------------------------------------

GOOD = {"event_id": 1, "device_id": "d", "device_type": "camera", "event_time": "2024-05-06T07:08:09Z", "event_duration": 2,
        "location": {"latitude": 1.5, "longitude": -2, "city": "c", "country": "k"},
        "metadata": {"firmware_version": "1", "battery_level": 5.0, "signal_strength": -7}}


def changed(**parts):
    out = json.loads(json.dumps(GOOD))
    for path, v in parts.items():
        at, *rest = path.split("__")
        inner = out
        while rest:
            inner, at = inner[at], rest.pop(0)
        if v is ...:
            del inner[at]
        else:
            inner[at] = v
    return json.dumps(out)


CASES = [
    (json.dumps(GOOD), []), (None, ["malformed_json"]), ("", ["malformed_json"]), ("{not", ["malformed_json"]),
    ("[]", ["type:$"]), ("7", ["type:$"]), ("null", ["null:$"]),
    (changed(event_id=...), ["required:event_id"]), (changed(event_id=None), ["null:event_id"]),
    (changed(event_id="1"), ["type:event_id"]), (changed(event_id=1.5), ["type:event_id"]), (changed(event_id=True), ["type:event_id"]),
    (changed(device_type="toaster"), ["enum:device_type"]), (changed(device_type=4), ["type:device_type"]),
    (changed(event_time="yesterday"), ["format:event_time"]), (changed(event_time="2024-05-06T07:08:09"), ["format:event_time"]),
    (changed(event_time="2024-13-06T07:08:09Z"), ["format:event_time"]),
    (changed(location=...), ["required:location"]), (changed(location=[1]), ["type:location"]), (changed(location=None), ["null:location"]),
    (changed(location__city=...), ["required:location.city"]), (changed(location__latitude="1"), ["type:location.latitude"]),
    (changed(metadata__battery_level=101), ["maximum:metadata.battery_level"]),
    (changed(metadata__battery_level=-1, metadata__signal_strength=1), ["minimum:metadata.battery_level", "maximum:metadata.signal_strength"]),
    (changed(metadata__battery_level=None), ["null:metadata.battery_level"]),
    (changed(metadata__battery_level={"a": 1}), ["type:metadata.battery_level"]),
]


def test_contract_tells_missing_null_and_wrong_type_apart(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, json_value string")
    got = {r.i: r.contract_violations for r in contract.check_contract(df, schemas.event_contract()).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}
    counts = {r["rule"]: r.row_count for r in contract.contract_counts(df, schemas.event_contract()).collect()}
    assert counts["malformed_json"] == 3 and counts["type:event_id"] == 3 and "type:device_id" not in counts


def test_contract_keywords(spark):
    doc = {"type": "object", "properties": {
        "a": {"type": ["integer", "null"], "exclusiveMinimum": 0, "exclusiveMaximum": 10},
        "it's": {"type": "string", "minLength": 2, "maxLength": 3, "pattern": "^x"}, "b": {"type": "array"}, "c": {"type": "boolean"},
        "d": {"description": "anything"}}, "required": ["e"]}
    rows = [('{"a":null,"e":1,"it\'s":"xy","b":[],"c":true,"d":[1]}', []), ('{"a":0,"e":null}', ["exclusiveMinimum:a"]),
            ('{"a":10,"e":1,"it\'s":"yyyy"}', ["exclusiveMaximum:a", "maxLength:it's", "pattern:it's"]),
            ('{"it\'s":"x","b":{},"c":0}', ["minLength:it's", "type:b", "type:c", "required:e"])]
    df = spark.createDataFrame([(t,) for t, _ in rows], "json_value string").coalesce(1)
    assert [r.contract_violations for r in contract.check_contract(df, doc).collect()] == [w for _, w in rows]
    for bad in ({"oneOf": []}, {"format": "uuid"}, {"type": "text"}, {"enum": [1]}):
        with pytest.raises(ValueError):
            contract.compile_contract(bad, F.col("v"), F.col("t"))
