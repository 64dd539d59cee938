"""Correctness gate: every catalogue query equals its DuckDB oracle at sf0.01."""

import pytest

from conftest import SF_ORACLE, SF_SMALL
from oracle_harness import compare, duck_connect

import __spark_entry__ as entry

from marketlake.plans import catalog

# The optional training-data queries have tests of their own.
QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


def test_entry_lists_the_catalogue():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE.get(name), SF_ORACLE, con)
    assert r["ok"] is not False, r
    assert "type_diff" not in r, r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == entry.entry(spark).columns  # stable schema
    assert df.columns[0] == "TIME"


def test_queries_run_on_smallest_scale(spark):
    for name, fn in QUERIES.items():
        assert fn(spark, SF_SMALL).count() >= 0, name
