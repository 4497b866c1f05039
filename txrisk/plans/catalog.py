"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the ``events`` table of ``sf_dir`` through the
transaction adapter and runs over all of it.  Decimal results are turned
into DOUBLE in the final projection only.  The DuckDB oracle for each
SQL-expressible query is in :mod:`txrisk.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.numeric import decimals_to_double as _report
from txrisk.operators import accounts as A
from txrisk.operators import filters as FL
from txrisk.operators import metrics as M
from txrisk.operators import model as ML
from txrisk.operators import profile as P
from txrisk.operators import balances as R
from txrisk.operators import cube as Q
from txrisk.operators import layout as L
from txrisk.operators import resample as B
from txrisk.operators import sampling as U
from txrisk.operators.velocity import with_velocity
from txrisk.plans import stages
from txrisk.session import ensure_checkpoint_dir, materialize
from txrisk.sources import files
from txrisk.sources.events import load_transactions
from txrisk.streaming.arrival import state_session, with_arrival_velocity
from txrisk.streaming.velocity import EVENT_TIME, step_of_hour, velocity_windows

# The example dashboard slice used by ``slice_view`` and
# ``slice_summary``.
EXAMPLE_SLICE = {"types": ("TRANSFER", "CASH_OUT", "PAYMENT"), "step_lo": 100,
                 "step_hi": 600, "fraud_only": False}

Query = Callable[[SparkSession, str], DataFrame]


def _tx(spark, d):
    return load_transactions(spark, d)


def _risky(spark, d):
    return load_transactions(spark, d, types=S.RISKY_TYPES)


def _enriched(spark, d):
    return stages.enriched_from_dir(spark, d)


def _train_split(spark, d):
    """Train and test parts of the risky rows; the step range reaches the
    scan.  Queries that use no enrichment column read these directly: the
    enrichment keeps every risky row exactly once, so the rows are the same,
    without the window and join."""
    return FL.train_test(load_transactions(spark, d, types=S.RISKY_TYPES, step_hi=S.SPLIT_STEP))[0]


def _test_split(spark, d):
    return FL.train_test(load_transactions(spark, d, types=S.RISKY_TYPES,
                                           step_lo=S.SPLIT_STEP + 1))[1]


_SHARED: dict = {}


def _stamp(spark, d):
    """The files behind ``events``: their paths, sizes and modification times."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{d.rstrip('/')}/events.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return (spark.sparkContext.applicationId, *sorted(out))


def _shared(spark, d):
    """What the model queries of one catalog share: fits of the very files that
    ``d`` holds now.  Files that change, or another folder, start it anew."""
    key = _stamp(spark, d)
    if key not in _SHARED:
        for old in _SHARED.values():
            if "run" in old:
                old["run"].close()
        _SHARED.clear()
        _SHARED[key] = {}
    return _SHARED[key]


def shared_run(spark, d):
    """The model run that the model queries share: fitted and scored here once."""
    shared = _shared(spark, d)
    if "run" not in shared:
        train = stages.enriched_from_dir(spark, d, step_hi=S.SPLIT_STEP)
        test = stages.enriched_from_dir(spark, d, step_lo=S.SPLIT_STEP + 1)
        shared["run"] = stages.model_run(spark, train, test=test)
    return shared["run"]


# -------------------------------------------------------------- profile
def q_risky_filter(spark, d):
    # the type filter is applied at the events scan (PushedFilters); the
    # mapped ``type`` column is re-checked by the generic operator
    return _report(FL.risky(_risky(spark, d)))


def q_overview(spark, d):
    return P.overview(_tx(spark, d))


def q_risky_overview(spark, d):
    """Rows, distinct origins and distinct destinations of the risky subset."""
    return P.overview(_risky(spark, d))


def q_positive_rate(spark, d):
    """Rows, fraud rows and fraud rate of the risky subset, before the split."""
    return P.positive_rate(_risky(spark, d))


def q_volume_by_type(spark, d):
    return _report(P.volume_by_type(_tx(spark, d)))


def q_fraud_rate_by_type(spark, d):
    return P.fraud_rate_by_type(_tx(spark, d))


def q_rule_recall(spark, d):
    return P.rule_recall(_tx(spark, d))


# -------------------------------------------------------------- accounts
def q_customer_features(spark, d):
    return _report(A.customer_features(_risky(spark, d)))


def q_top_customers(spark, d):
    return _report(A.top_customers(A.customer_features(_risky(spark, d))))


def q_customer_profile(spark, d):
    return A.customer_profile(A.customer_features(_risky(spark, d)))


def q_dest_frequency(spark, d):
    return _report(A.dest_frequency(_risky(spark, d)))


def q_dest_reuse_histogram(spark, d):
    return A.dest_reuse_histogram(A.dest_frequency(_risky(spark, d)))


def q_fraud_destinations(spark, d):
    return _report(A.fraud_destinations(A.dest_frequency(_risky(spark, d))))


# -------------------------------------------------------------- enrichment
def q_dest_velocity(spark, d):
    v = with_velocity(_risky(spark, d))
    return _report(v.select(S.TX_ID, S.DEST, S.STEP, S.VELOCITY_COUNT, S.VELOCITY_AMOUNT))


def q_reconcile(spark, d):
    r = R.reconcile(_risky(spark, d))
    return _report(r.select(S.TX_ID, S.ORIG_DIFF, S.DEST_DIFF, S.ORIG_MISMATCH, S.DEST_MISMATCH))


def q_enriched_transactions(spark, d):
    return _report(_enriched(spark, d))


def q_velocity_by_label(spark, d):
    return R.velocity_by_label(_enriched(spark, d))


def q_mismatch_by_label(spark, d):
    # reconciliation only: the velocity columns are not needed here
    return R.mismatch_by_label(R.reconcile(_risky(spark, d)))


def q_mismatch_long(spark, d):
    return R.mismatch_long(R.mismatch_by_label(R.reconcile(_risky(spark, d))))


def q_velocity_windows(spark, d):
    """The streaming velocity operator run as a batch over the whole table."""
    tx = load_transactions(spark, d, types=S.RISKY_TYPES, event_time=EVENT_TIME)
    v = velocity_windows(tx, watermark=None)
    return _report(v.select(S.DEST, step_of_hour().alias(S.STEP), S.VELOCITY_COUNT,
                            S.VELOCITY_AMOUNT))


# -------------------------------------------------------------- slices / dashboard
def _slice(spark, d, types=None, **kw):
    """A dashboard slice; its type set and step range are also applied at the
    scan."""
    steps = {k: kw.get(k) for k in ("step_lo", "step_hi")}
    return FL.slice_tx(load_transactions(spark, d, types=types, **steps), types=types, **kw)


def q_slice_view(spark, d):
    return _report(_slice(spark, d, **EXAMPLE_SLICE))


def q_slice_domain(spark, d):
    dom = FL.slice_domain(_tx(spark, d))
    return dom.select(F.array_join("types", ",").alias("types"), "step_min", "step_max")


def q_slice_summary(spark, d):
    return FL.slice_summary(_slice(spark, d, **EXAMPLE_SLICE))


def q_kpis(spark, d):
    return P.kpis(FL.slice_tx(_tx(spark, d)))


def q_activity_by_step(spark, d):
    return P.activity_by_step(FL.slice_tx(_tx(spark, d)))


def q_top_destinations(spark, d):
    return _report(P.top_destinations(FL.slice_tx(_tx(spark, d))))


def q_amount_histogram(spark, d):
    return P.amount_histogram(FL.slice_tx(_tx(spark, d)))


def q_split_summary(spark, d):
    return P.split_summary(_risky(spark, d))


def q_time_split(spark, d):
    return FL.time_split(_risky(spark, d)).select(S.TX_ID, S.STEP, "split")


def q_legit_sample(spark, d):
    s = U.legit_sample(FL.slice_tx(_tx(spark, d)))
    return _report(s.select(S.TX_ID, S.STEP, S.TYPE, S.AMOUNT, S.LABEL))


def q_legit_sample_one_scan(spark, d):
    """The same sample from a summary made in one scan."""
    view = FL.slice_tx(_tx(spark, d)).where(F.col(S.LABEL) == 0).select(S.TX_ID, S.STEP, S.TYPE, S.AMOUNT, S.LABEL)
    return _report(U.bottom_k(view, 50_000).drop(U.DIGEST))


def q_legit_sample_merged(spark, d):
    """The same sample from the stored summary of earlier rows, merged with later ones."""
    view = _tx(spark, d).where(F.col(S.LABEL) == 0).select(S.TX_ID, S.STEP, S.TYPE, S.AMOUNT, S.LABEL)
    early = F.coalesce(F.col(S.STEP) <= S.SPLIT_STEP, F.lit(True))
    stored = materialize(U.bottom_k(view.where(early), 50_000), "sample")
    return _report(U.merge_bottom_k(50_000, stored, U.bottom_k(view.where(~early), 50_000)).drop(U.DIGEST))


def q_stratified_sample(spark, d):
    s = U.stratified_sample(_tx(spark, d))
    return _report(s.select(S.TX_ID, S.STEP, S.TYPE, S.AMOUNT, S.LABEL))


# -------------------------------------------------------------- model inputs
def q_class_weight(spark, d):
    train = _train_split(spark, d)
    return ML.with_class_weight(train).select(S.TX_ID, S.LABEL, ML.WEIGHT)


def q_type_index(spark, d):
    train = _train_split(spark, d)
    return ML.type_index(ML.type_indexer().fit(train), train)


# -------------------------------------------------------------- rule metrics
def q_confusion_rule(spark, d):
    return M.confusion(_test_split(spark, d), pred=S.RULE)


def q_confusion_cells(spark, d):
    return M.confusion_cells(M.confusion(_test_split(spark, d), pred=S.RULE))


def q_prf_rule(spark, d):
    return M.prf(M.confusion(_test_split(spark, d), pred=S.RULE))


def q_auc_amount(spark, d):
    return M.auc_exact(_test_split(spark, d), score=S.AMOUNT)


def q_rule_baseline_test(spark, d):
    return M.rule_baseline(_test_split(spark, d))


def q_rule_false_negatives(spark, d):
    return _report(M.errors(_test_split(spark, d), "fn", pred=S.RULE))


def q_rule_false_positives(spark, d):
    return _report(M.errors(_test_split(spark, d), "fp", pred=S.RULE))


def q_rule_false_negatives_top(spark, d):
    """The first ten missed fraud rows."""
    return _report(M.errors(_test_split(spark, d), "fn", pred=S.RULE, n=10))


def _amount_score():
    """A deterministic score in [0, 1) rising with the amount (a stand-in for
    a model score where an exact oracle is wanted)."""
    a = F.col(S.AMOUNT).cast("double")
    return a / (a + F.lit(100.0))


def q_rule_metrics_by_band(spark, d):
    return M.metrics_by_band(_test_split(spark, d), pred=S.RULE)


def q_threshold_costs_amount(spark, d):
    return M.threshold_costs(_test_split(spark, d), score=_amount_score())


def q_best_threshold_amount(spark, d):
    return M.best_threshold(M.threshold_costs(_test_split(spark, d), score=_amount_score()))


def q_best_threshold_exact_amount(spark, d):
    """The best of all distinct scores, not of a grid."""
    return M.exact_best_threshold(_test_split(spark, d), score=_amount_score())


# ------------------------------------- the model reports on a deterministic score
def _amount_predictions(spark, d):
    return (_test_split(spark, d).withColumn("fraud_prob", _amount_score())
            .withColumn("prediction", (F.col("fraud_prob") > 0.5).cast("double")))


def q_score_histogram_amount(spark, d):
    return M.score_histogram(_amount_predictions(spark, d), prob="fraud_prob")


def q_model_vs_rule_amount(spark, d):
    return M.compare_to_rule(_amount_predictions(spark, d))


def q_amount_false_negatives(spark, d):
    return _report(M.errors(_amount_predictions(spark, d), "fn", extra=("fraud_prob",)))


def q_amount_false_positives(spark, d):
    return _report(M.errors(_amount_predictions(spark, d), "fp", extra=("fraud_prob",)))


def q_gbt_invariants(spark, d):
    """What holds for any fit: one prediction for each test row, probabilities
    in [0, 1], and the prediction is that of a probability over one half."""
    p = F.col("fraud_prob")
    right = p.between(0, 1) & (F.col("prediction") == (p > 0.5).cast("double"))
    return shared_run(spark, d).predictions.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(S.TX_ID).alias("ids"),
        F.sum(S.LABEL).cast("long").alias("positives"),
        F.count_if(~F.coalesce(right, F.lit(False))).alias("violations"))


# -------------------------------------------------------------- model (rows-only checks)
def q_gbt_predictions(spark, d):
    p = shared_run(spark, d).predictions
    return p.select(S.TX_ID, S.STEP, S.TYPE, S.AMOUNT, S.LABEL, "prediction", "fraud_prob")


def q_feature_importance(spark, d):
    run = shared_run(spark, d)
    return ML.importances(spark, run.model, run.features)


def q_model_metrics(spark, d):
    return stages.model_metrics(shared_run(spark, d))


def q_model_vs_rule(spark, d):
    return M.compare_to_rule(shared_run(spark, d).predictions)


def q_ablation(spark, d):
    shared, run = _shared(spark, d), shared_run(spark, d)
    if "ablation" not in shared:
        shared["ablation"] = stages.ablation(
            spark, run.train, models={"full": run.model}, predictions={"full": run.predictions},
            test=run.test)
    return shared["ablation"]


def q_ablation_long(spark, d):
    return q_ablation(spark, d).unpivot(["feature_set"], ["auc", "recall", "precision", "f1"],
                                        "metric", "value")


def q_estimator_comparison(spark, d):
    shared, run = _shared(spark, d), shared_run(spark, d)
    if "estimators" not in shared:
        shared["estimators"] = stages.compare_estimators(spark, run.train, models={"gbt": run.model},
                                                         predictions={"gbt": run.predictions}, test=run.test)
    return shared["estimators"]


def q_score_histogram(spark, d):
    return M.score_histogram(shared_run(spark, d).predictions)


def q_model_false_negatives(spark, d):
    return M.errors(shared_run(spark, d).predictions, "fn", extra=("fraud_prob",))


def q_model_false_positives(spark, d):
    return M.errors(shared_run(spark, d).predictions, "fp", extra=("fraud_prob",))


# ------------------------------------------------------------- layouts and stored state
def _folder(spark, name):
    """A new folder beside the session's intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/txrisk-{name}-{uuid.uuid4().hex}"


def q_arrival_velocity(spark, d):
    """Velocity by the state of each destination, over the table as one micro-batch."""
    tx = load_transactions(state_session(spark), d, types=S.RISKY_TYPES, event_time=EVENT_TIME)
    v = with_arrival_velocity(tx, watermark=None)
    return _report(v.select(S.TX_ID, S.DEST, S.STEP, S.VELOCITY_COUNT, S.VELOCITY_AMOUNT))


def q_layout_velocity(spark, d):
    """Velocity from the bucketed layout: written once, joined bucket by bucket."""
    layout = L.write_velocity_layout(_risky(spark, d), _folder(spark, "velocity-layout"), buckets=8)
    v = L.velocity_of_layout(spark, layout)
    return _report(v.select(S.TX_ID, S.DEST, S.STEP, S.VELOCITY_COUNT, S.VELOCITY_AMOUNT))


def _clustered(spark, d):
    path = _folder(spark, "clustered")
    L.write_clustered(_tx(spark, d), path)
    return path


def q_clustered_table(spark, d):
    """The clustered table read back whole."""
    return _report(L.read_clustered(spark, _clustered(spark, d)))


def q_clustered_steps(spark, d):
    """A range of steps of the clustered table."""
    return _report(L.read_clustered(spark, _clustered(spark, d), step_lo=300, step_hi=340))


def q_clustered_account(spark, d):
    """The rows of one account (the first by name) in the clustered table."""
    path = _clustered(spark, d)
    first = _tx(spark, d).agg(F.min(S.DEST)).first()[0]
    return _report(L.read_clustered(spark, path, account=first))


def _by_split(spark, d):
    risky = _risky(spark, d)
    early = F.coalesce(F.col(S.STEP) <= S.SPLIT_STEP, F.lit(True))
    return risky.where(early), risky.where(~early)


def q_customer_features_merged(spark, d):
    """Account features of a stored state that a second batch was merged into."""
    path = _folder(spark, "account-state")
    for version, rows in enumerate(_by_split(spark, d)):
        state = A.update_state(path, A.account_state(rows), version)
    return _report(A.features_of_state(state))


def q_dest_frequency_merged(spark, d):
    path = _folder(spark, "dest-state")
    for version, rows in enumerate(_by_split(spark, d)):
        state = A.update_state(path, A.dest_frequency(rows), version, A.merge_dest_frequency)
    return _report(state)


# ------------------------------------------------------------- cube
def _cube(spark, d):
    return materialize(Q.slice_cube(_tx(spark, d)), "cube")


def q_cube_slices(spark, d):
    """Every three-day window of every type, from running sums."""
    cube = _cube(spark, d)
    windows = (cube.where("step IS NOT NULL AND type IS NOT NULL").select("type", F.floor(F.col("step") / 24).alias("day")).distinct()
               .select("type", (F.col("day") * 24).cast("int").alias("step_lo"), (F.col("day") * 24 + 71).cast("int").alias("step_hi")))
    return Q.cube_slices(cube, windows)


def q_cube_kpis(spark, d):
    """KPIs of the example slice, without a scan of its rows."""
    s = {k: v for k, v in EXAMPLE_SLICE.items() if k != "fraud_only"}
    return Q.cube_kpis(_cube(spark, d), **s)


def q_cube_activity(spark, d):
    return Q.cube_activity(_cube(spark, d))


def q_sketch_bounds(spark, d):
    """Exact distinct counts per type, and whether the united sketches of its steps
    are within their stated error."""
    tx = _tx(spark, d)
    sketches = materialize(Q.distinct_sketches(tx), "sketches")
    near = sketches.groupBy("type").agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"{c}_near") for c in ("origins", "destinations")])
    exact = tx.groupBy(F.col(S.TYPE).alias("type")).agg(F.count_distinct(S.ORIG).alias("origins"), F.count_distinct(S.DEST).alias("destinations"))
    within = lambda c: F.abs(F.col(f"{c}_near") - F.col(c)) <= F.greatest(F.lit(1), F.ceil(F.col(c) * F.lit(Q.SKETCH_ERROR)))
    return exact.join(near, "type").select("type", "origins", "destinations", within("origins").cast("int").alias("origins_within"),
                                           within("destinations").cast("int").alias("destinations_within"))


# ------------------------------------------------------------- resampling
def q_bootstrap_confusion_amount(spark, d):
    return B.bootstrap_confusion(_amount_predictions(spark, d))


def q_bootstrap_intervals_amount(spark, d):
    return B.bootstrap_intervals(B.bootstrap_confusion(_amount_predictions(spark, d)))


def q_permuted_amount(spark, d):
    """The amounts of the test split dealt anew."""
    return _report(B.permuted(_test_split(spark, d).select(S.TX_ID, S.AMOUNT), S.AMOUNT))


def q_rolling_folds(spark, d):
    return B.fold_counts(B.rolling_folds(_risky(spark, d)))


def q_rolling_origin(spark, d):
    """Rows, positives and confusion totals of a fit per fold (10 trees each)."""
    r = B.rolling_origin(stages.enriched_from_dir(spark, d, step_hi=max(B.ORIGINS) + B.HORIZON), maxIter=10)
    ok = F.col("auc").between(0, 1) & F.col("precision").between(0, 1) & F.col("recall").between(0, 1)
    return r.select("fold", "train_rows", "test_rows", "positives", ok.cast("int").alias("valid"))


# ------------------------------------------------------------- files written and read back
def q_csv_roundtrip(spark, d):
    """Raw CSV with a header, read with the declared schema."""
    path = _folder(spark, "csv")
    _tx(spark, d).drop(S.TX_ID).write.option("header", "true").csv(path)
    return _report(files.read_csv(spark, path))


def q_partitioned_roundtrip(spark, d):
    path = _folder(spark, "by-type")
    files.write_tx(_tx(spark, d), path)
    return _report(files.read_tx(spark, path))


def q_enriched_roundtrip(spark, d):
    path = _folder(spark, "flat")
    files.write_table(_enriched(spark, d), path)
    return _report(files.read_table(spark, path))


def q_predictions_roundtrip(spark, d):
    """The predictions sink read back, against the predictions it was given."""
    path, given = _folder(spark, "sink"), shared_run(spark, d).predictions
    files.write_predictions(given, path)
    got = files.read_table(spark, path)
    both = got.join(given.select(S.TX_ID, F.col("prediction").alias("p"), F.col("margin").alias("m")), S.TX_ID, "full")
    same = (F.col("prediction") == F.col("p")) & (F.col("margin") == F.col("m"))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.sum(S.LABEL).cast("long").alias("positives"),
                    F.count_if(~F.coalesce(same, F.lit(False))).alias("differing"))


def q_model_roundtrip(spark, d):
    """The model saved and loaded scores the test split as it did before."""
    path, run = _folder(spark, "model"), shared_run(spark, d)
    files.save_model(run.model, path)
    again = ML.score(files.load_model(path), run.test).select(S.TX_ID, F.col("fraud_prob").alias("p"))
    both = run.predictions.select(S.TX_ID, "fraud_prob").join(again, S.TX_ID, "full")
    same = F.coalesce(F.abs(F.col("fraud_prob") - F.col("p")) < 1e-12, F.lit(False))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("differing"))


# ------------------------------------------------------------- what holds for any fit
def q_importance_invariants(spark, d):
    run = shared_run(spark, d)
    return ML.importances(spark, run.model, run.features).agg(
        F.count(F.lit(1)).alias("features"), F.count_if(F.col("importance") < 0).alias("negative"),
        (F.abs(F.sum("importance") - 1) < 1e-9).cast("int").alias("sum_is_one"))


def _valid_report(df, name):
    p, r, f = F.col("precision"), F.col("recall"), F.col("f1")
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    ok = F.col("auc").between(0, 1) & p.between(0, 1) & r.between(0, 1) & (F.abs(f - f1) < 1e-12)
    return df.select(name, ok.cast("int").alias("valid"))


def q_ablation_invariants(spark, d):
    return _valid_report(q_ablation(spark, d), "feature_set")


def q_ablation_long_invariants(spark, d):
    return q_ablation_long(spark, d).groupBy("feature_set").agg(
        F.count(F.lit(1)).alias("metrics"), F.count_if(~F.col("value").between(0, 1)).alias("outside"))


def q_estimator_invariants(spark, d):
    return _valid_report(q_estimator_comparison(spark, d), "estimator")


def q_permutation_importance(spark, d):
    run = shared_run(spark, d)
    return B.permutation_importance(run.model, run.test, run.features)


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items()
            if name.startswith("q_") and callable(fn)}


# Queries checked by row count only (model outputs depend on the learner).
ROWS_ONLY = ("gbt_predictions", "feature_importance", "model_metrics", "model_vs_rule",
             "ablation", "ablation_long", "estimator_comparison", "score_histogram", "model_false_negatives",
             "model_false_positives", "permutation_importance")

# Queries that read the shared fits.
MODEL_QUERIES = (*ROWS_ONLY, "gbt_invariants", "predictions_roundtrip", "model_roundtrip", "importance_invariants",
                 "ablation_invariants", "ablation_long_invariants", "estimator_invariants", "rolling_origin")
