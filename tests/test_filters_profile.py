from pyspark.sql import functions as F

from conftest import SF001, tx_frame, tx_row
from txrisk import schema as S
from txrisk.operators import filters as FL
from txrisk.operators import profile as P
from txrisk.sources.events import load_transactions


def test_empty_type_set_means_all(spark):
    tx = load_transactions(spark, SF001)
    assert FL.slice_tx(tx, types=[]).count() == tx.count()
    assert FL.slice_tx(tx, types=None).count() == tx.count()


def test_slice_bounds_are_closed(spark):
    df = tx_frame(spark, [tx_row(i, i, fraud=i % 2) for i in range(1, 11)])
    assert FL.slice_tx(df, step_lo=3, step_hi=5).count() == 3
    assert FL.slice_tx(df, step_lo=3, step_hi=5, fraud_only=True).count() == 2


def test_time_split_is_partition(spark):
    tx = load_transactions(spark, SF001)
    s = FL.time_split(tx)
    n_null = tx.where(F.col(S.STEP).isNull()).count()
    assert s.count() + n_null == tx.count()
    train, test = FL.train_test(tx)
    assert train.count() + test.count() == s.count()
    assert s.where("split = 'train'").count() == train.count()


def test_slice_domain_and_summary(spark):
    tx = load_transactions(spark, SF001)
    d = FL.slice_domain(tx).first()
    assert d["types"] == sorted(S.TX_TYPES) and d["step_min"] >= 1 and d["step_max"] <= 744
    s = FL.slice_summary(tx).first()
    assert s["rows"] == tx.count()
    assert s["fraud"] == tx.where(F.col(S.LABEL) == 1).count()


def test_histogram_totals_equal_rows(spark):
    tx = load_transactions(spark, SF001)
    h = P.amount_histogram(tx)
    assert h.agg(F.sum("count")).first()[0] == tx.where(F.col(S.AMOUNT).isNotNull()).count()
    bins = [r["bin"] for r in h.select("bin").distinct().collect()]
    assert min(bins) == 0 and max(bins) == 59


def test_histogram_single_value(spark):
    df = tx_frame(spark, [tx_row(1, 1), tx_row(2, 1)])
    rows = P.amount_histogram(df).collect()
    assert len(rows) == 1 and rows[0]["bin"] == 0 and rows[0]["count"] == 2


def test_overview_counts_null_key_once(spark):
    df = tx_frame(spark, [tx_row(1, 1, dest=None), tx_row(2, 1, dest=None), tx_row(3, 1)])
    o = P.overview(df).first()
    assert o["destinations"] == 2 and o["tx_count"] == 3
    assert P.overview(df, count_null=False).first()["destinations"] == 1


def test_fraud_rate_zero_total_guard(spark):
    df = tx_frame(spark, [tx_row(1, 1, fraud=None)])
    r = P.fraud_rate_by_type(df).first()
    assert r["total"] == 1 and r["fraud_rate_pct"] is None


def test_rule_recall_without_fraud(spark):
    df = tx_frame(spark, [tx_row(1, 1, fraud=0, flagged=1)])
    r = P.rule_recall(df).first()
    assert (r["total_fraud"], r["flagged_fraud"], r["recall_pct"]) == (0, 0, None)


def test_overview_approx_close_to_exact(spark):
    tx = load_transactions(spark, "/root/testdata/sf0.01")
    exact = P.overview(tx, count_null=False).first()
    approx = P.overview(tx, count_null=False, approx=True).first()
    assert approx["tx_count"] == exact["tx_count"]
    for c in ("origins", "destinations"):
        assert abs(approx[c] - exact[c]) <= 0.1 * exact[c]
