"""The events -> transactions mapping handles NULLs the same way in Spark
and in the DuckDB oracle (the test tables contain none)."""

import datetime as dt

import duckdb
import pandas as pd

from txrisk.plans.oracle import TX
from txrisk.sources.events import EVENTS_SCHEMA, events_to_transactions

ROWS = [
    (1, dt.datetime(2024, 1, 3, 4, 5, 6), 7, "purchase", 120.25, None),
    (2, dt.datetime(2024, 1, 30, 23, 59, 0), 8, "click", 180.50, None),
    (3, dt.datetime(2024, 1, 10, 1, 0, 0), None, "view", 10.0, None),
    (4, None, 9, "purchase", 99.99, None),
    (5, dt.datetime(2024, 1, 4, 0, 0, 0), 10, None, 15.0, None),
    (6, dt.datetime(2024, 1, 5, 0, 0, 0), 11, "purchase", None, None),
    (None, dt.datetime(2024, 1, 6, 0, 0, 0), 12, "click", 5.0, None),
    (20, dt.datetime(2024, 1, 7, 0, 0, 0), 13, "signup", 0.0, None),
]


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(float(v) if hasattr(v, "as_tuple") else v for v in r))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_null_handling_matches_oracle(spark):
    sdf = events_to_transactions(spark.createDataFrame(ROWS, EVENTS_SCHEMA))
    cols = sdf.columns
    con = duckdb.connect()
    pdf = pd.DataFrame(ROWS, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
    pdf["event_id"] = pdf["event_id"].astype("Int64")
    pdf["user_id"] = pdf["user_id"].astype("Int64")
    con.register("events_raw", pdf)
    con.execute("CREATE VIEW events AS SELECT CAST(event_id AS BIGINT) AS event_id, "
                "CAST(ts AS TIMESTAMP) AS ts, CAST(user_id AS BIGINT) AS user_id, event_type, "
                "CAST(value AS DOUBLE) AS value, props FROM events_raw")
    res = con.execute("WITH " + TX + " SELECT " + ", ".join(cols) + " FROM tx").fetchall()
    assert _norm(tuple(r) for r in sdf.collect()) == _norm(res)
