"""Batch jobs for files on disk, one per stage of the original workflow.

    python -m txrisk.plans.jobs explore   --csv raw.csv         --out DIR
    python -m txrisk.plans.jobs customers --out DIR
    python -m txrisk.plans.jobs destinations --out DIR
    python -m txrisk.plans.jobs model     --out DIR
    python -m txrisk.plans.jobs ablation  --out DIR
    python -m txrisk.plans.jobs inspect   --out DIR

``DIR`` holds ``transactions`` (partitioned by type), ``customer_features``,
``enriched_transactions``, ``fraud_model`` and ``predictions``.  Each job
returns its report DataFrames by name; the CLI prints them.  Tables are
written once and reports are computed from the written tables: the test split
is enriched and scored a single time, and every model report reads the written
predictions.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.numeric import decimals_to_double
from txrisk.operators import accounts as A
from txrisk.operators import balances as B
from txrisk.operators import metrics as M
from txrisk.operators import model as ML
from txrisk.operators import profile as P
from txrisk.operators.filters import risky
from txrisk.plans import stages
from txrisk.sources import files


def _p(out: str, name: str) -> str:
    return f"{out.rstrip('/')}/{name}"


def explore(spark: SparkSession, csv_path: str, out: str) -> dict[str, DataFrame]:
    """CSV -> type-partitioned Parquet; profile reports from the Parquet."""
    tx = stages.ingest(spark, csv_path, _p(out, "transactions"))
    return {
        "overview": P.overview(tx),
        "volume_by_type": decimals_to_double(P.volume_by_type(tx)),
        "fraud_rate_by_type": P.fraud_rate_by_type(tx),
        "rule_recall": P.rule_recall(tx),
    }


def customers(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Origin-account features of risky rows, written; top and profile."""
    tx = files.read_tx(spark, _p(out, "transactions"))
    files.write_table(A.customer_features(risky(tx)), _p(out, "customer_features"))
    feats = files.read_table(spark, _p(out, "customer_features"))
    return {
        "customer_count": feats.agg(F.count(F.lit(1)).alias("customers")),
        "top_customers": decimals_to_double(A.top_customers(feats)),
        "customer_profile": A.customer_profile(feats),
    }


def destinations(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Destination profile, rolling velocity and reconciliation; the
    enriched risky rows are written once and summarised from disk."""
    tx = files.read_tx(spark, _p(out, "transactions"))
    files.write_table(stages.enrich(tx), _p(out, "enriched_transactions"))
    enriched = files.read_table(spark, _p(out, "enriched_transactions"))
    freq = A.dest_frequency(risky(tx))
    return {
        "destinations": freq.agg(F.count(F.lit(1)).alias("destinations")),
        "dest_reuse_histogram": A.dest_reuse_histogram(freq),
        "fraud_destinations": decimals_to_double(A.fraud_destinations(freq)),
        "velocity_by_label": B.velocity_by_label(enriched),
        "mismatch_by_label": B.mismatch_by_label(enriched),
    }


def model(spark: SparkSession, out: str, **gbt_params) -> dict[str, DataFrame]:
    """Split, weight, fit, evaluate, compare with the rule; save the model
    and the projected predictions."""
    enriched = files.read_table(spark, _p(out, "enriched_transactions"))
    run = stages.model_run(spark, enriched, **gbt_params)
    files.save_model(run.model, _p(out, "fraud_model"))
    files.write_predictions(run.predictions, _p(out, "predictions"))
    run.close()
    preds = files.read_table(spark, _p(out, "predictions"))
    return {
        "split_summary": P.split_summary(enriched),
        "class_weight": ML.with_class_weight(run.train).agg(
            F.max(ML.WEIGHT).alias("fraud_weight")),
        "metrics": stages.metrics_of(preds),
        "confusion": M.confusion_cells(M.confusion(preds)),
        "model_vs_rule": M.compare_to_rule(preds),
        "feature_importance": ML.importances(spark, run.model, run.features),
    }


def ablation(spark: SparkSession, out: str, **gbt_params) -> dict[str, DataFrame]:
    enriched = files.read_table(spark, _p(out, "enriched_transactions"))
    return {"ablation": stages.ablation(spark, enriched, **gbt_params)}


def inspect(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Missed fraud and false alarms among the saved predictions."""
    from txrisk.functions.vectors import positive_probability

    preds = files.read_table(spark, _p(out, "predictions")).withColumn(
        "fraud_prob", positive_probability())
    return {
        "missed_fraud": decimals_to_double(M.errors(preds, "fn", extra=("fraud_prob",))),
        "false_alarms": decimals_to_double(M.errors(preds, "fp", extra=("fraud_prob",))),
    }


JOBS = {"explore": explore, "customers": customers, "destinations": destinations,
        "model": model, "ablation": ablation, "inspect": inspect}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="txrisk.plans.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--out", required=True, help="folder of the stage tables")
    ap.add_argument("--csv", help="raw CSV (explore)")
    ap.add_argument("--rows", type=int, default=20, help="rows to print per report")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"txrisk-{args.job}").getOrCreate()
    if args.job == "explore":
        reports = explore(spark, args.csv, args.out)
    else:
        reports = JOBS[args.job](spark, args.out)
    for name, df in reports.items():
        print(f"== {name}")
        df.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
