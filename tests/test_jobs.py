"""The stage jobs chained on files, from a raw CSV to error listings."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF01
from txrisk import schema as S
from txrisk.plans import jobs
from txrisk.plans.catalog import queries
from txrisk.sources.events import load_transactions


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_jobs_chain(spark):
    out = tempfile.mkdtemp(prefix="txrisk-jobs-")
    csv = f"{out}/raw"
    load_transactions(spark, SF01).drop(S.TX_ID).write.option("header", "true").csv(csv)
    r1 = jobs.explore(spark, csv, out)
    q = queries()
    assert _rows(r1["volume_by_type"]) == _rows(q["volume_by_type"](spark, SF01))
    assert _rows(r1["fraud_rate_by_type"]) == _rows(q["fraud_rate_by_type"](spark, SF01))
    r2 = jobs.customers(spark, out)
    assert _rows(r2["customer_profile"]) == _rows(q["customer_profile"](spark, SF01))
    r3 = jobs.destinations(spark, out)
    assert _rows(r3["mismatch_by_label"]) == _rows(q["mismatch_by_label"](spark, SF01))
    assert _rows(r3["velocity_by_label"]) == _rows(q["velocity_by_label"](spark, SF01))
    r4 = jobs.model(spark, out, maxIter=5)
    m = r4["metrics"].first()
    assert m["tp"] + m["fn"] == r4["split_summary"].where("split = 'test'").first()["positives"]
    assert r4["feature_importance"].count() == 12
    r6 = jobs.inspect(spark, out)
    assert r6["missed_fraud"].count() == m["fn"] and r6["false_alarms"].count() == m["fp"]
    assert spark.read.parquet(f"{out}/predictions").where(F.col("prediction").isNull()).count() == 0


def test_cli_prints_reports(spark, capsys):
    out = tempfile.mkdtemp(prefix="txrisk-cli-")
    load_transactions(spark, "/root/testdata/sf0.001").drop(S.TX_ID) \
        .write.option("header", "true").csv(f"{out}/raw")
    jobs.main(["explore", "--csv", f"{out}/raw", "--out", out, "--rows", "3"])
    jobs.main(["customers", "--out", out, "--rows", "3"])
    text = capsys.readouterr().out
    for name in ("overview", "volume_by_type", "fraud_rate_by_type", "rule_recall",
                 "top_customers", "customer_profile"):
        assert f"== {name}" in text
