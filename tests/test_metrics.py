import random

from pyspark.sql import functions as F

from conftest import SF01
from txrisk import schema as S
from txrisk.operators import metrics as M
from txrisk.plans import stages


def _brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    acc = 0.0
    for p in pos:
        for n in neg:
            acc += 1.0 if p > n else 0.5 if p == n else 0.0
    return acc / (len(pos) * len(neg))


def test_auc_exact_matches_brute_force_with_ties(spark):
    rnd = random.Random(7)
    pairs = [(float(rnd.randint(0, 30)), int(rnd.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "score double, isFraud int")
    for parts in (1, 3, 8):
        got = M.auc_exact(df, partitions=parts).first()["auc"]
        assert abs(got - _brute_auc(pairs)) < 1e-12


def test_auc_exact_degenerate(spark):
    df = spark.createDataFrame([(0.5, 1), (0.7, 1)], "score double, isFraud int")
    assert M.auc_exact(df).first()["auc"] is None
    df2 = spark.createDataFrame([(0.2, 0), (0.9, 1)], "score double, isFraud int")
    assert M.auc_exact(df2).first()["auc"] == 1.0


def test_prf_zero_denominators(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "isFraud int, prediction int")
    r = M.prf(M.confusion(df)).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    df2 = spark.createDataFrame([(0, 1), (0, 0)], "isFraud int, prediction int")
    r2 = M.prf(M.confusion(df2)).first()
    assert (r2["precision"], r2["recall"]) == (0.0, 0.0)


def test_confusion_cells_sum(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "isFraud int, prediction int")
    cells = {(r["actual"], r["predicted"]): r["n"]
             for r in M.confusion_cells(M.confusion(df)).collect()}
    assert cells == {(1, 1): 1, (1, 0): 1, (0, 1): 1, (0, 0): 2}


def test_errors_lists_every_row(spark):
    test = stages.enriched_from_dir(spark, SF01).where(F.col(S.STEP) > 600)
    fn = M.errors(test, "fn", pred=S.RULE)
    conf = M.confusion(test, pred=S.RULE).first()
    assert fn.count() == conf["fn"]
    assert M.errors(test, "fp", pred=S.RULE).count() == conf["fp"]


def test_score_histogram_top_bin(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (0, 0.024), (1, 0.5)], "isFraud int, p double")
    rows = {(r[0], r[1]): r[2] for r in M.score_histogram(df, prob="p").collect()}
    assert rows == {(1, 39): 1, (0, 0): 2, (1, 20): 1}


def test_threshold_costs_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.random() if i % 7 else 1.0, int(rnd.random() < 0.2)) for i in range(300)]
    df = spark.createDataFrame(rows, "p double, isFraud int")
    got = {r["k"]: (r["fn"], r["fp"], r["cost"]) for r in M.threshold_costs(df, score="p", grid=20).collect()}
    assert sorted(got) == list(range(22))
    for k in range(22):
        fn = sum(1 for p, y in rows if y == 1 and not p * 20 >= k)
        fp = sum(1 for p, y in rows if y == 0 and p * 20 >= k)
        assert got[k] == (fn, fp, 10.0 * fn + fp)
    best = M.best_threshold(M.threshold_costs(df, score="p", grid=20)).first()
    assert best["cost"] == min(v[2] for v in got.values())


def test_metrics_by_band(spark):
    rows = [(50.0, 1, 1), (50.0, 0, 1), (150.0, 1, 0), (2000.0, 0, 0), (None, 1, 1)]
    df = spark.createDataFrame(rows, "amount double, isFraud int, prediction int")
    got = {r["band"]: r for r in M.metrics_by_band(df).collect()}
    assert got[0]["rows"] == 2 and got[0]["precision"] == 0.5 and got[0]["band_hi"] == 100.0
    assert got[1]["fn"] == 1 and got[1]["recall"] == 0.0
    assert got[2]["band_lo"] == 1000.0 and got[None]["rows"] == 1


def test_threshold_costs_scores_outside_unit_interval(spark):
    rows = [(-0.5, 1), (-0.01, 0), (0.0, 1), (0.55, 0), (1.0, 1), (1.5, 0), (3.0, 1)]
    df = spark.createDataFrame(rows, "p double, isFraud int")
    got = {r["k"]: (r["fn"], r["fp"]) for r in M.threshold_costs(df, score="p", grid=10).collect()}
    assert sorted(got) == list(range(12))
    for k in range(12):
        fn = sum(1 for p, y in rows if y == 1 and not p * 10 >= k)
        fp = sum(1 for p, y in rows if y == 0 and p * 10 >= k)
        assert got[k] == (fn, fp), k
