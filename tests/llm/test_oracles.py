"""Queries with a SQL twin, on the small tables."""

import duckdb
import pytest

from partsnap.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    result = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    want = sorted(map(repr, result.fetchall()))
    assert sorted(columns) == sorted(df.columns)
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want
