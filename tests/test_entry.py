"""Driver contract: entry() runs the flagship query; every query has a callable, every oracle a query."""

import os

import pytest

import __spark_entry__ as entry

pytestmark = pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001/events.parquet"),
                                reason="driver tables absent")


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"window_start", "service_name", "host_id", "cpu_utilization_zscore"} <= set(df.columns)


def test_contract_shapes():
    queries = entry.queries()
    sql = entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert all(callable(q) for q in queries.values())
