"""Every registered query against its DuckDB twin (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from oracle_check import SF_SMALL, compare
from partsnap.plans.registry import QUERIES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "_side"
    assert df.count() == 286


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    [(got, n_spark, n_duck, ok, _)] = compare(spark, SF_SMALL, [name])
    if name in E.oracle_sql():
        assert ok, f"{name}: spark {n_spark} rows, duckdb {n_duck} rows"
    else:
        assert n_spark > 0


def test_every_sql_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
