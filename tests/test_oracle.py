"""Every registered query against its SQL oracle, exactly, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from parcelsight.testbed import oracle
from parcelsight.testbed.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_oracle(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == oracle.ANSWERS.keys()
    assert QUERIES.keys() <= entry.queries().keys() and QUERIES.keys() <= entry.oracle_sql().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
