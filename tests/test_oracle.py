"""Every registered query against its DuckDB oracle SQL (sf0.001; the driver runs sf0.01)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle_sql():
    assert set(entry._QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert ok, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "shape", "ts_iso", "document"]
