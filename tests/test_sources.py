"""Readers."""

import pytest
from pyspark.errors import AnalysisException

from devpulse.session import scratch_path
from devpulse.sources.files import read_any, read_json_events
from devpulse.sources.kafka import kafka_options, read_kafka_events
from devpulse.sources.tables import events_as_raw, load_table


def test_read_any_parquet_then_json(spark):
    raw = events_as_raw(load_table(spark, "/root/testdata/sf0.001", "events"))
    pq, js = scratch_path(spark, "t-pq"), scratch_path(spark, "t-js")
    raw.write.parquet(pq)
    raw.write.json(js)
    assert read_any(spark, pq).count() == 1000
    assert read_any(spark, js).count() == 1000
    assert sorted(read_json_events(spark, js).columns) == sorted(raw.columns)


def test_read_any_missing_path_raises(spark):
    with pytest.raises(AnalysisException):
        read_any(spark, "/nonexistent/devpulse/path")


def test_kafka_options_and_missing_connector(spark):
    opts = kafka_options("broker:9092")
    assert opts["subscribe"] == "input_events" and "maxOffsetsPerTrigger" not in opts
    assert opts["failOnDataLoss"] == "true" and opts["startingOffsets"] == "latest"
    tuned = kafka_options("broker:9092", max_offsets=700, fail_on_loss=False)
    assert tuned["maxOffsetsPerTrigger"] == "700" and tuned["failOnDataLoss"] == "false"
    assert "minPartitions" not in opts
    assert kafka_options("broker:9092", min_partitions=64)["minPartitions"] == "64"
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_events(spark, "broker:9092")
