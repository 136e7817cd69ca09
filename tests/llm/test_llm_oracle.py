"""Registered training-data queries against their DuckDB SQL."""

import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

from eventloom.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    ok, msg = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE_SQL[name], SF_SMALL)
    assert ok, msg
