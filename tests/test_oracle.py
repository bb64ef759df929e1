"""Every registered query against its DuckDB SQL, at sf0.001 (the driver
repeats this at sf0.01)."""

import pytest

from conftest import SF0001
from oracle_check import compare, duck

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF0001, name, QUERIES[name], ORACLE[name])
    assert r["cols_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF0001).count() > 0
