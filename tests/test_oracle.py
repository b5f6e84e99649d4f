"""Every registered query against its DuckDB SQL at sf0.01 (the driver's check), plus the smoke entry."""

import pytest

import __spark_entry__ as E
from devpulse.plans import catalog
from tests.oracle_harness import compare, duck

SF01 = "/root/testdata/sf0.01"
NAMES = list(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_sql():
    assert set(NAMES) <= set(E.oracle_sql())
    assert set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    n, problems = compare(spark, con, E.queries()[name], E.oracle_sql()[name], SF01)
    assert not problems, problems
    assert n > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["device_type", "event_date", "percentile_95", "mean_duration", "stddev_duration",
                          "total_events", "distinct_devices"]
    assert df.count() == 97
