"""Answers at the edges: empty slices, small tolerances, large totals, NaN
scores, malformed input, file counts."""

import glob
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF001, plan_text, tx_frame, tx_row
from txrisk import schema as S
from txrisk.operators import accounts as A
from txrisk.operators import balances as B
from txrisk.operators import metrics as M
from txrisk.operators import profile as P
from txrisk.sources import files
from txrisk.sources.events import load_transactions


def test_empty_slice(spark):
    none = tx_frame(spark, [tx_row(1, 1)]).where("false")
    assert P.overview(none).first() == (0, 0, 0)
    k = P.kpis(none).first()
    assert (k.transactions, k.fraud_cases, k.fraud_rate_pct, k.origins, k.destinations) == (0, 0, 0.0, 0, 0)


def test_tolerance_is_not_rounded(spark):
    df = tx_frame(spark, [tx_row(1, 1, old_orig="100.00", new_orig="90.01"), tx_row(2, 1)])
    got = {r[S.TX_ID]: r[S.ORIG_MISMATCH] for r in B.reconcile(df, tolerance=0.005).collect()}
    assert got == {1: 1, 2: 0}
    assert {r[S.ORIG_MISMATCH] for r in B.reconcile(df).collect()} == {0}


def test_profile_of_totals_beyond_a_double(spark):
    big = "9999999999999999.99"
    df = tx_frame(spark, [tx_row(i, 1, orig="C1", amount=big) for i in range(3)] + [tx_row(9, 1, orig="C2", amount="0.01")])
    r = A.customer_profile(A.customer_features(df)).first()
    exact = (Decimal(big) * 3 + Decimal("0.01")) / 2
    assert r.customer_count == 2 and r.avg_total_sent == float(round(exact, 2))


@pytest.mark.parametrize("parts", [1, 4, 21])
def test_auc_with_nan_scores(spark, parts):
    nan = float("nan")
    rows = [(i % 2, i / 7.0) for i in range(20)] + [(1, nan), (0, nan), (1, nan)]
    df = spark.createDataFrame(rows, "isFraud int, score double")
    # NaN is one score above all others
    plain = [(y, 1e300 if s != s else s) for y, s in rows]
    pos, neg = [s for y, s in plain if y], [s for y, s in plain if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.auc_exact(df, partitions=parts).first()["auc"] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_threshold(spark, parts):
    import random

    rng = random.Random(parts)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(300)]
    df = spark.createDataFrame(rows + [(1, None), (0, float("nan"))], "isFraud int, fraud_prob double")
    for cost_fn, cost_fp in ((10.0, 1.0), (1.0, 1.0), (1.0, 50.0)):
        costs = []
        for t in sorted({s for _, s in rows}) + [None]:
            fn = sum(y == 1 and (t is None or s < t) for y, s in rows)
            fp = sum(y == 0 and t is not None and s >= t for y, s in rows)
            costs.append((cost_fn * fn + cost_fp * fp, t, fn, fp))
        best = min(costs, key=lambda c: (c[0], c[1] is None, c[1] or 0))
        got = M.exact_best_threshold(df, cost_fn=cost_fn, cost_fp=cost_fp, partitions=parts).first()
        assert (got.cost, got.threshold, got.fn, got.fp) == best
    assert M.exact_best_threshold(df.where("false")).collect() == []


def _csv(lines):
    path = tempfile.mkdtemp(prefix="txrisk-csv-") + "/raw.csv"
    with open(path, "w") as f:
        f.write(",".join(c for c in S.TX_COLUMNS if c != S.TX_ID) + "\n" + "\n".join(lines) + "\n")
    return path


def test_malformed_csv(spark):
    line = "1,TRANSFER,{},C1,100.00,90.00,M1,0.00,10.00,0,0"
    path = _csv([line.format(a) for a in ("10.00", "ten", "2.505", "")])
    with pytest.raises(PySparkException, match="malformed amount: ten|malformed amount: 2.505"):
        files.read_csv(spark, path).collect()
    assert [r[S.AMOUNT] for r in files.read_csv(spark, path, on_bad_row="null").collect()] == [
        Decimal("10.00"), None, Decimal("2.51"), None]
    kept = files.read_csv(spark, path, on_bad_row="keep")
    assert kept.where(F.col(files.BAD_ROW).isNotNull()).count() == 2
    good = _csv([line.format(a) for a in ("10.00", "0.1", "")])
    assert [r[S.AMOUNT] for r in files.read_csv(spark, good).collect()] == [Decimal("10.00"), Decimal("0.10"), None]


def test_partitioned_write_makes_few_files(spark):
    out = tempfile.mkdtemp(prefix="txrisk-write-")
    tx = load_transactions(spark, SF001).repartition(64)
    files.write_tx(tx, f"{out}/tx")
    per_type = [len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{out}/tx/type=*")]
    assert len(per_type) == 5 and max(per_type) <= 3
    assert files.read_tx(spark, f"{out}/tx").count() == tx.count()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_text(tx.hint("rebalance", S.TYPE))


def test_dominant_type_is_split(spark):
    out = tempfile.mkdtemp(prefix="txrisk-write-")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(200_000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"),
                                                          F.when(F.col("id") % 1000 == 0, "DEBIT").otherwise("TRANSFER").alias("type"))
        files.write_tx(df, f"{out}/tx")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{out}/tx/type=TRANSFER/*.parquet")]
    assert len(sizes) > 4 and max(sizes) < 0.5 * sum(sizes)


def test_years_are_not_folded(spark):
    import datetime as dt

    from txrisk.operators.velocity import with_velocity
    from txrisk.sources.events import EVENTS_SCHEMA, events_to_transactions
    from txrisk.streaming import EVENT_TIME, velocity_windows

    rows = [(i, dt.datetime(y, 1, 5, 10), 7, "purchase", 10.0, None) for i, y in ((1, 2024), (2, 2025))]
    tx = events_to_transactions(spark.createDataFrame(rows, EVENTS_SCHEMA), event_time=EVENT_TIME)
    batch = {r[S.TX_ID]: r[S.VELOCITY_COUNT] for r in with_velocity(tx).collect()}
    assert batch == {1: 1, 2: 1}
    assert [r[S.VELOCITY_COUNT] for r in velocity_windows(tx, watermark=None).collect()] == [1, 1]
