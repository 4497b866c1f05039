"""Velocity on arrival: state per destination."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from txrisk import schema as S
from txrisk.operators.velocity import with_velocity
from txrisk.plans import stages
from txrisk.sources.events import load_transactions
from txrisk.streaming import read_event_stream
from txrisk.streaming.arrival import run_arrival_scoring, state_session, with_arrival_velocity


def _hourly_files(ev, out, hours):
    """Files whose bounds are hours, in the order of time."""
    at = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) * 24 + F.hour("ts")
    lo, hi = ev.agg(F.min(at), F.max(at)).first()
    for a in range(lo, hi + 1, hours):
        part = ev.where((at >= a) & (at < a + hours))
        if not part.isEmpty():
            part.coalesce(1).write.mode("append").parquet(out)


def _run(spark, path, table, d, watermark="1 hour"):
    own = state_session(spark)
    stream = read_event_stream(own, path, max_files_per_trigger=1)
    q = (with_arrival_velocity(stream, watermark).writeStream.outputMode("append").format("parquet")
         .option("path", f"{d}/{table}").option("checkpointLocation", f"{d}/ckpt-{table}").trigger(availableNow=True).start())
    q.awaitTermination(600)
    return q, spark.read.parquet(f"{d}/{table}")


def _values(df):
    return {r[0]: (r[1], r[2]) for r in df.select(S.TX_ID, S.VELOCITY_COUNT, S.VELOCITY_AMOUNT).collect()}


def test_in_order_input_equals_the_batch_frame(spark):
    d = tempfile.mkdtemp(prefix="txrisk-arrival-")
    _hourly_files(spark.read.parquet(f"{SF001}/events.parquet"), f"{d}/in", 72)
    _, got = _run(spark, f"{d}/in", "out", d)
    batch = with_velocity(load_transactions(spark, SF001, types=S.RISKY_TYPES))
    assert _values(got) == _values(batch)
    # the row itself leaves as it came
    cols = [c for c in batch.columns if c not in (S.VELOCITY_COUNT, S.VELOCITY_AMOUNT)]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, at string, user_id long, event_type string, value double, props string").selectExpr(
        "event_id", "CAST(at AS TIMESTAMP_NTZ) AS ts", "user_id", "event_type", "value", "props")


def test_late_rows_and_bounded_state(spark):
    d = tempfile.mkdtemp(prefix="txrisk-arrival-")
    row = lambda i, at, user=1, v=1.0: (i, f"2024-01-{at}", user, "click", v, "")
    batches = [
        [row(1, "02 00:10:00"), row(2, "02 05:10:00")],
        [row(3, "02 05:50:00"), row(4, "02 04:30:00")],   # a peer, and a late row within the watermark
        [row(5, "09 00:00:00"), row(6, "09 00:30:00", user=2)],   # time moves on: the old cells go
        [row(7, "02 05:55:00")],                            # behind the watermark: dropped
        [row(8, "09 01:00:00")]]
    for i, rows in enumerate(batches):
        _events(spark, rows).coalesce(1).write.mode("append").parquet(f"{d}/in")
        q, got = _run(spark, f"{d}/in", "out", d, watermark="2 hours")  # each run resumes from the checkpoint
    values = {k: v[0] for k, v in _values(got).items()}
    assert values == {1: 1, 2: 2, 3: 4, 4: 2, 5: 1, 6: 1, 8: 2}
    cells = state_session(spark).read.format("statestore").option("path", f"{d}/ckpt-out").option("stateVarName", "cells").load()
    assert cells.count() <= 3  # the hours of the 9th, none of the 2nd


def test_restart_counts_every_row_once(spark):
    d = tempfile.mkdtemp(prefix="txrisk-arrival-")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    for part in (F.dayofyear("ts") <= 15, F.dayofyear("ts") > 15):
        ev.where(part).coalesce(1).write.mode("append").parquet(f"{d}/in")
        _, got = _run(spark, f"{d}/in", "out", d, watermark="1 day")
    assert _values(got) == _values(with_velocity(load_transactions(spark, SF001, types=S.RISKY_TYPES)))
    assert got.count() == len(_values(got))


def test_scoring_on_arrival_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="txrisk-arrival-")
    _hourly_files(spark.read.parquet(f"{SF001}/events.parquet"), f"{d}/in", 240)
    run = stages.model_run(spark, stages.enriched_from_dir(spark, SF01), maxIter=2)
    run_arrival_scoring(spark, f"{d}/in", f"{d}/out", run.model, available_now=True, max_files_per_trigger=1).awaitTermination(600)
    got = spark.read.parquet(f"{d}/out").select(S.TX_ID, "prediction", "fraud_prob")
    want = stages.ML.score(run.model, stages.enriched_from_dir(spark, SF001)).select(S.TX_ID, "prediction", "fraud_prob")
    a, b = ({r[0]: r[1:] for r in df.collect()} for df in (got, want))
    assert a.keys() == b.keys()
    assert all(a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], abs=1e-12) for k in a)


def test_the_callers_session_is_not_changed(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    assert state_session(spark).conf.get(key) != before or "RocksDB" in before
    assert spark.conf.get(key) == before


def test_null_amounts_and_keys(spark):
    tx = spark.createDataFrame([(1, "A", None, 0), (2, "A", None, 0), (3, None, "5.00", 0), (4, None, None, 3600), (5, "B", "9999999999999999.99", 0),
                                (6, "B", "9999999999999999.99", 60)], "tx_id long, nameDest string, amount string, at long").selectExpr(
        "tx_id", "nameDest", "CAST(amount AS DECIMAL(18,2)) AS amount", "timestamp_seconds(at) AS event_time", "CAST(at / 3600 AS INT) AS step")
    own = state_session(spark)
    got = with_arrival_velocity(own.createDataFrame(tx.collect(), tx.schema), watermark=None)
    assert _values(got) == _values(with_velocity(tx))
