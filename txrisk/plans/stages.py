"""The workflow stages as DataFrame plans.

* ingest   -- raw CSV -> type-partitioned Parquet, plus the profile reports
* enrich   -- risky rows -> rolling destination velocity -> reconciliation
* model    -- time split, class weight, GBT fit, scoring, evaluation
* ablation -- the model fit per feature set, one metrics row each

Stages return lazy DataFrames; fitting, scoring and the model reports run
jobs.  No fit is kept between calls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.operators import metrics as M
from txrisk.operators import model as ML
from txrisk.operators.filters import risky, train_test
from txrisk.operators.balances import reconcile
from txrisk.operators.velocity import with_velocity
from txrisk.session import discard, materialize
from txrisk.sources import files
from txrisk.sources.events import load_transactions


def ingest(spark: SparkSession, csv_path: str, out_path: str) -> DataFrame:
    """Raw CSV (declared schema) -> Parquet partitioned by type.  Adds a
    ``tx_id``.  Returns the written table, read back with partition
    discovery."""
    raw = files.with_tx_id(files.read_csv(spark, csv_path))
    files.write_tx(raw, out_path)
    return files.read_tx(spark, out_path)


def enrich(tx: DataFrame, types=S.RISKY_TYPES, exclude_current: bool = False) -> DataFrame:
    """Risky rows with rolling destination velocity and reconciliation."""
    return reconcile(with_velocity(risky(tx, types), exclude_current=exclude_current))


def enriched_from_dir(spark: SparkSession, sf_dir: str, step_lo: int | None = None,
                      step_hi: int | None = None) -> DataFrame:
    """Enriched rows for a test-data directory; the type filter and the step
    range reach the scan of ``events``.  Rows from ``step_lo`` on need the
    rows of the lookback before it and no others (the frame is closed)."""
    lo = None if step_lo is None else step_lo - S.LOOKBACK_STEPS
    rows = with_velocity(load_transactions(spark, sf_dir, types=S.RISKY_TYPES,
                                           step_lo=lo, step_hi=step_hi))
    return reconcile(rows if step_lo is None else rows.where(F.col(S.STEP) >= step_lo))


def raw_score():
    """Class-1 margin of the classifier (the usual AUC input)."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col("rawPrediction")).getItem(1)


MARGIN = "margin"
SCORED_COLUMNS = (S.TX_ID, S.STEP, S.TYPE, S.AMOUNT, S.LABEL, S.RULE, "prediction", "probability",
                  "rawPrediction", MARGIN, "fraud_prob")


def score_once(model: PipelineModel, test: DataFrame) -> DataFrame:
    """The scored test split, written once: label, rule flag, prediction,
    probability and margin.  Every metric reads this table, so the rows are
    enriched and scored a single time."""
    scored = ML.score(model, test).withColumn(MARGIN, raw_score())
    cols = [c for c in SCORED_COLUMNS if c in scored.columns]
    return materialize(scored.select(*cols), "predictions")


@dataclass
class ModelRun:
    model: PipelineModel
    features: list
    train: DataFrame
    test: DataFrame
    predictions: DataFrame

    def close(self) -> None:
        """Remove the written predictions."""
        discard(self.predictions)


def parallel_fits(session: SparkSession, jobs: dict, parallelism: int | None = None) -> dict:
    """Fit every (pipeline, prepared rows) of ``jobs``, from parallel threads that
    keep the caller's job group and scheduler pool (Spark runs their jobs
    concurrently, as CrossValidator does with its ``parallelism``)."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    with ThreadPoolExecutor(max_workers=max(1, parallelism or len(jobs))) as pool:
        futures = {n: pool.submit(inheritable_thread_target(session)(p.fit), rows) for n, (p, rows) in jobs.items()}
        return {n: f.result() for n, f in futures.items()}


def model_run(spark: SparkSession, enriched: DataFrame, features=ML.FULL_FEATURES,
              split_step: int = S.SPLIT_STEP, test: DataFrame | None = None,
              **gbt_params) -> ModelRun:
    """Split by step, fit on train, score test.  ``test`` may give the test
    split as a cheaper plan of the same rows.  Nothing is kept between calls:
    pass the returned run on to share a fit."""
    train, own_test = train_test(enriched, split_step)
    test = own_test if test is None else test
    weighted = ML.prepare_train(train)
    try:
        model = ML.fit_prepared(weighted, features, **gbt_params)
    finally:
        discard(weighted)
    return ModelRun(model, list(features), train, test, score_once(model, test))


def fit_all(spark: SparkSession, enriched: DataFrame, feature_sets: dict,
            split_step: int = S.SPLIT_STEP, parallelism: int | None = None,
            **gbt_params) -> dict:
    """Fit one model per feature set on one prepared train split."""
    weighted = ML.prepare_train(train_test(enriched, split_step)[0])
    try:
        return parallel_fits(spark, {n: (ML.build_pipeline(cols, **gbt_params), weighted)
                                     for n, cols in feature_sets.items()}, parallelism)
    finally:
        discard(weighted)


def metrics_of(predictions: DataFrame) -> DataFrame:
    """One row of a predictions table: AUC (exact, on the raw margin),
    confusion counts, precision, recall, F1 at the default threshold."""
    auc = M.auc_exact(predictions, score=MARGIN)
    return _one_row_join(M.prf(M.confusion(predictions)), auc)


def model_metrics(run: ModelRun) -> DataFrame:
    return metrics_of(run.predictions)


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side by side of two single-row aggregates (each is exactly one row,
    so the pairing is one row; no fan-out is possible)."""
    cols = b.columns
    return a.select("*", *[b.select(c).scalar().alias(c) for c in cols])


def _report(spark: SparkSession, models: dict, test: DataFrame, name_col: str,
            predictions: dict | None = None) -> DataFrame:
    """AUC, recall, precision and F1 per model.  The enriched test split is
    written once and scored once per model; ``predictions`` holds tables that
    exist already.  The report is a handful of numbers, so the tables are
    removed before it is returned."""
    predictions = dict(predictions or {})
    own, rows = [], []
    if set(models) - set(predictions):
        own.append(materialize(test, "test"))
    try:
        for name, model in models.items():
            if name not in predictions:
                predictions[name] = score_once(model, own[0])
                own.append(predictions[name])
            m = metrics_of(predictions[name]).first()
            rows.append((name, m["auc"], m["recall"], m["precision"], m["f1"]))
    finally:
        for df in own:
            discard(df)
    return spark.createDataFrame(
        rows, f"{name_col} string, auc double, recall double, precision double, f1 double")


def ablation(spark: SparkSession, enriched: DataFrame, feature_sets=None, models: dict | None = None,
             predictions: dict | None = None, test: DataFrame | None = None,
             **gbt_params) -> DataFrame:
    """Fit and evaluate once per feature set: AUC, recall, precision, F1.
    ``models`` and ``predictions`` pass in fits and tables that exist."""
    feature_sets = feature_sets or ML.FEATURE_SETS
    models = dict(models or {})
    todo = {n: cols for n, cols in feature_sets.items() if n not in models}
    if todo:
        models |= fit_all(spark, enriched, todo, **gbt_params)
    return _report(spark, {n: models[n] for n in feature_sets},
                   train_test(enriched)[1] if test is None else test, "feature_set", predictions)


def compare_estimators(spark: SparkSession, enriched: DataFrame, features=ML.FULL_FEATURES,
                       estimators: dict | None = None, split_step: int = S.SPLIT_STEP,
                       models: dict | None = None, predictions: dict | None = None,
                       test: DataFrame | None = None) -> DataFrame:
    """Fit each estimator on the same prepared train split (from parallel
    threads) and evaluate on the test split: AUC, recall, precision, F1."""
    estimators = estimators or ML.baseline_estimators()
    train, own_test = train_test(enriched, split_step)
    models = dict(models or {})
    todo = {n: ML.build_pipeline(features, estimator=e) for n, e in estimators.items() if n not in models}
    if todo:
        weighted = ML.prepare_train(train)
        try:
            models |= parallel_fits(spark, {n: (p, weighted) for n, p in todo.items()})
        finally:
            discard(weighted)
    return _report(spark, {n: models[n] for n in estimators}, own_test if test is None else test,
                   "estimator", predictions)
