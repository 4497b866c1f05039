"""Queries against their DuckDB SQL on a whole small table."""

import duckdb
import pytest

from txrisk.llm import queries

SF = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.sql(SQL[name])
    assert sorted(want.columns) == cols
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(want.select(*cols).fetchall(), key=key)
