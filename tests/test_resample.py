"""Bootstrap, permutation and rolling-origin folds."""

import hashlib
import math

from pyspark.sql import functions as F

from conftest import SF001, SF01, plan_text
from txrisk import schema as S
from txrisk.operators import resample as B
from txrisk.plans import oracle, stages
from txrisk.sources.events import load_transactions


def test_weights_are_poisson(spark):
    steps = B.poisson_steps()
    assert tuple(steps) == oracle.POISSON_STEPS
    assert abs(steps[0] / 2**32 - math.exp(-1)) < 1e-9
    got = spark.range(20000).select("id", B.poisson_weight(F.col("id"), F.lit(3)).alias("w")).collect()
    for r in got[:300]:
        u = int(hashlib.md5(f"42:3:{r.id}".encode()).hexdigest()[:8], 16)
        assert r.w == sum(u >= s for s in steps)
    mean = sum(r.w for r in got) / len(got)
    assert abs(mean - 1) < 0.03 and abs(sum((r.w - mean) ** 2 for r in got) / len(got) - 1) < 0.06


def _preds(spark, n):
    return spark.range(n).select(F.col("id").alias(S.TX_ID), (F.col("id") % 5 == 0).cast("int").alias(S.LABEL),
                                 (F.col("id") % 7 < 3).cast("double").alias("prediction"), (F.col("id") % 10 == 0).cast("int").alias(S.RULE))


def test_replicates_do_not_depend_on_the_layout(spark):
    a, b = (B.bootstrap_confusion(_preds(spark, 2000).repartition(p), replicates=7).orderBy("replicate").collect() for p in (1, 9))
    assert a == b and len(a) == 7 and len({tuple(r)[1:] for r in a}) > 1


def test_a_digest_is_made_once_a_replicate_and_equal_rows_are_counted(spark):
    preds = _preds(spark, 300)
    some = preds.unionByName(preds.where("tx_id < 40")).unionByName(preds.limit(5).withColumn(S.TX_ID, F.lit(None).cast("long")))
    out = B.bootstrap_confusion(some, replicates=6)
    assert plan_text(out, "simple").count("md5(") == 1 and "conv(" not in plan_text(out, "simple")
    want = {}
    for r in some.collect():
        for i in range(1, 7):
            text = f"42:{i}" + ("" if r.tx_id is None else f":{r.tx_id}")
            w = sum(int(hashlib.md5(text.encode()).hexdigest()[:8], 16) >= s for s in B.poisson_steps())
            t = want.setdefault(i, [0] * 5)
            t[{(1, 1): 0, (1, 0): 1, (0, 1): 2, (0, 0): 3}[r.isFraud, int(r.prediction)]] += w
            t[4] += w * (r.isFraud == r.isFlaggedFraud == 1)
    assert {r.replicate: list(r)[1:] for r in out.collect()} == want


def test_intervals_hold_the_plain_value(spark):
    p = _preds(spark, 5000)
    r = {x.metric: x for x in B.bootstrap_intervals(B.bootstrap_confusion(p)).collect()}
    tp = p.where("isFraud = 1 AND prediction = 1").count()
    rule = p.where("isFraud = 1 AND isFlaggedFraud = 1").count()
    plain = {"recall": tp / 1000, "precision": tp / p.where("prediction = 1").count(), "rule_recall": rule / 1000, "model_vs_rule": tp / rule}
    for m, v in plain.items():
        assert r[m].low <= r[m].median <= r[m].high and r[m].low - 0.02 <= v <= r[m].high + 0.02
    none = B.bootstrap_intervals(B.bootstrap_confusion(p.where("isFlaggedFraud = 0")))
    assert "model_vs_rule" not in {x.metric for x in none.collect()}
    assert B.bootstrap_intervals(B.bootstrap_confusion(p.where("false"))).collect() == []


def test_a_permutation_is_a_bijection(spark):
    df = load_transactions(spark, SF001).select(S.TX_ID, S.AMOUNT, S.TYPE)
    out = B.permuted(df, S.AMOUNT)
    assert out.columns == df.columns and out.count() == df.count()
    for c in (S.AMOUNT, S.TX_ID):
        assert sorted(out.select(c).collect()) == sorted(df.select(c).collect())
    assert sorted(out.select(S.TX_ID, S.TYPE).collect()) == sorted(df.select(S.TX_ID, S.TYPE).collect())
    moved = out.alias("a").join(df.alias("b"), S.TX_ID).where("a.amount <> b.amount").count()
    assert moved > 0.9 * df.count()
    again = B.permuted(df.repartition(3), S.AMOUNT)
    assert sorted(out.collect()) == sorted(again.collect())
    assert sorted(out.collect()) != sorted(B.permuted(df, S.AMOUNT, seed=7).collect())
    assert B.permuted(df.where("false"), S.AMOUNT).collect() == []


def test_permutation_importance(spark):
    enr = stages.enriched_from_dir(spark, SF01)
    run = stages.model_run(spark, enr, maxIter=5)
    got = {r.feature: r.auc_drop for r in B.permutation_importance(run.model, run.test, ["orig_balance_diff", "type_idx", "oldbalanceDest"]).collect()}
    assert set(got) == {"orig_balance_diff", "type_idx", "oldbalanceDest"}
    assert max(got, key=got.get) == "orig_balance_diff" and got["orig_balance_diff"] > 0.01


def test_no_fold_trains_on_its_future(spark):
    folds = B.rolling_folds(load_transactions(spark, SF001, types=S.RISKY_TYPES))
    ends = {(r.fold, r.split): r for r in B.fold_counts(folds).collect()}
    for i, origin in enumerate(B.ORIGINS, 1):
        train, test = ends[i, "train"], ends[i, "test"]
        assert train.step_max <= origin < test.step_min and test.step_max <= origin + B.HORIZON
    assert [ends[i, "train"].rows for i in range(1, 5)] == sorted(ends[i, "train"].rows for i in range(1, 5))


def test_rolling_origin_fits_each_fold(spark):
    enr = stages.enriched_from_dir(spark, SF01)
    got = B.rolling_origin(enr, origins=(300, 600), horizon=144, maxIter=3).orderBy("fold").collect()
    for r, origin in zip(got, (300, 600)):
        test = enr.where((F.col(S.STEP) > origin) & (F.col(S.STEP) <= origin + 144))
        assert r.test_rows == test.count() and r.positives == test.where("isFraud = 1").count()
        assert r.train_rows == enr.where(F.col(S.STEP) <= origin).count() and 0.5 < r.auc <= 1
