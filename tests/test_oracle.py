"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

from conftest import SF001
from txrisk.plans import catalog, oracle

SQL = oracle.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return repr(v)  # strict: -0.0 and 0.0 differ
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return float(v)
    return v


def _key(t):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF001}/events.parquet')")
    return c


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = catalog.queries()[name](spark, SF001)
    rel = con.sql(SQL[name])
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for f in sdf.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == duck_types[f.name], (f.name, f.dataType)
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = [dcols.index(c) for c in sdf.columns]
    a = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in order) for r in res.fetchall()), key=_key)
    assert a == b


def test_every_query_has_oracle_or_is_model_output():
    from txrisk.plans.catalog import ROWS_ONLY
    assert set(catalog.queries()) == set(SQL) | set(ROWS_ONLY)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 2 and not any(math.isnan(r["orig_mismatch_pct"]) for r in rows)
