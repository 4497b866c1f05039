from pyspark.sql import functions as F

from conftest import SF01
from txrisk import schema as S
from txrisk.operators import metrics as M
from txrisk.operators import model as ML
from txrisk.plans import stages


def test_indexer_order_unseen_and_null(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "type string")
    idx = ML.type_indexer().fit(train)
    got = {r[0]: r[1] for r in idx.transform(train).select("type", "type_idx").distinct().collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}
    other = spark.createDataFrame([("z",), (None,)], "type string")
    assert [r[0] for r in idx.transform(other).select("type_idx").collect()] == [3.0, 3.0]


def test_class_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "isFraud int")
    w = {r[0]: r[1] for r in ML.with_class_weight(df).select("isFraud", "class_weight").distinct().collect()}
    assert w == {1: 3.0, 0: 1.0}


def test_fit_requires_positives(spark):
    enr = stages.enriched_from_dir(spark, SF01).where(F.col(S.LABEL) == 0)
    try:
        ML.fit(enr.where(F.col(S.STEP) <= 600), maxIter=2)
    except ValueError as e:
        assert "no positive" in str(e)
    else:
        raise AssertionError("expected ValueError")


def test_gbt_deterministic_and_evaluator_agrees(spark):
    enr = stages.enriched_from_dir(spark, SF01)
    a = stages.model_run(spark, enr, maxIter=5)
    b = stages.model_run(spark, enr, maxIter=5)
    pa = a.predictions.select(S.TX_ID, "fraud_prob").orderBy(S.TX_ID).collect()
    pb = b.predictions.select(S.TX_ID, "fraud_prob").orderBy(S.TX_ID).collect()
    assert pa == pb
    exact = M.auc_exact(a.predictions, score=stages.raw_score()).first()["auc"]
    assert abs(exact - M.auc_evaluator(a.predictions)) < 1e-6
    imp = ML.importances(spark, a.model, a.features).collect()
    assert len(imp) == 12 and abs(sum(r[1] for r in imp) - 1.0) < 1e-9


def test_ablation_ordering(spark):
    enr = stages.enriched_from_dir(spark, SF01)
    sets = {k: ML.FEATURE_SETS[k] for k in ("full", "no_balance_at_all")}
    rows = {r["feature_set"]: r for r in stages.ablation(spark, enr, feature_sets=sets, maxIter=10).collect()}
    assert rows["full"]["auc"] > rows["no_balance_at_all"]["auc"]
    m = stages.model_metrics(stages.model_run(spark, enr, maxIter=10)).first()
    assert m["tp"] + m["fn"] == enr.where((F.col(S.STEP) > 600) & (F.col(S.LABEL) == 1)).count()


def test_rewritten_input_changes_the_model(spark):
    """Nothing is kept between runs: other labels give another model."""
    enr = stages.enriched_from_dir(spark, SF01)
    a = stages.model_run(spark, enr, maxIter=3)
    flipped = enr.withColumn(S.LABEL, (F.col(S.AMOUNT) > 100).cast("int"))
    b = stages.model_run(spark, flipped, maxIter=3)
    of = lambda r: [x[1] for x in ML.importances(spark, r.model, r.features).orderBy("feature").collect()]
    assert of(a) != of(b)


FIT = """
import json, sys
sys.path.insert(0, sys.argv[2])
from txrisk.session import local_session
spark = local_session(sys.argv[1])
from pyspark.sql import functions as F
from txrisk.plans import stages
enr = stages.enriched_from_dir(spark, "/root/testdata/sf0.1")
run = stages.model_run(spark, enr, maxIter=2)
rows = run.predictions.agg(F.sum("prediction"), F.sum(F.round("fraud_prob", 9)), F.count("*")).first()
print(json.dumps([*rows, [round(x, 9) for x in run.model.stages[-1].featureImportances.toArray().tolist()]]))
"""


def test_model_does_not_depend_on_the_cores():
    import json
    import subprocess
    import sys

    from conftest import ROOT

    got = []
    for cores in ("2", "8"):
        out = subprocess.run([sys.executable, "-c", FIT, cores, str(ROOT)], capture_output=True, text=True, timeout=600)
        got.append(json.loads(out.stdout.strip().splitlines()[-1]))
    (p, s, n, imp), (p2, s2, n2, imp2) = got
    assert (p, n) == (p2, n2) and abs(s - s2) < 1e-6
    assert all(abs(a - b) < 1e-6 for a, b in zip(imp, imp2))


def test_partitions_follow_the_rows(spark):
    assert [ML.train_partitions(n) for n in (1, 33_312, 1_600_000, 1_600_001, 10**10)] == [8, 8, 8, 9, 50_000]
    train = spark.range(100).select(F.col("id").alias(S.TX_ID), (F.col("id") % 2).cast("int").alias(S.LABEL))
    assert ML.prepare_train(train).rdd.getNumPartitions() == 8
