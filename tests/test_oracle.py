"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from ledgerlint.oracle.compare import compare_one, duckdb_connection

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare_one(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_every_query_has_an_oracle():
    own = {n for n in QUERIES if n.startswith(("dq_", "mf_"))}
    assert own == {n for n in SQL if n.startswith(("dq_", "mf_"))}


def test_entry_runs_with_a_stable_schema(spark):
    a = entry.entry(spark)
    b = entry.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
