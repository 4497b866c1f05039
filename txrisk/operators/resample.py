"""Resampling: bootstrap intervals (M4, M6), a distributed permutation of a column
(M7) and rolling-origin folds (M8, U1)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.operators.metrics import _ratio0

REPLICATES = 50
SEED = 42
_RANGE = 1 << 32


def poisson_steps(mean: float = 1.0) -> list[int]:
    """Where the distribution function of a Poisson count passes, in 2**32 parts."""
    out, cdf, p = [], 0.0, math.exp(-mean)
    while True:
        cdf += p
        at = int(cdf * _RANGE)
        if at >= _RANGE or (out and at == out[-1]):
            return out
        out.append(at)
        p *= mean / len(out)


def poisson_weight(key: Column, replicate: Column, seed: int = SEED) -> Column:
    """How often a row is drawn in a replicate: a Poisson(1) count of the digest of
    (seed, replicate, key), the same on any engine, layout and number of tasks."""
    text = F.concat_ws(":", F.lit(str(seed)), replicate.cast("string"), key.cast("string"))
    return _steps_passed(F.substring(F.md5(text), 1, 8))


def _steps_passed(digits: Column) -> Column:
    """The Poisson count of 8 hex digits; such digits (lower case) sort as their numbers do."""
    out = None
    for n, at in enumerate(poisson_steps()):
        below = digits < F.lit(f"{at:08x}")
        out = F.when(below, n) if out is None else out.when(below, n)
    return out.otherwise(len(poisson_steps()))


def bootstrap_confusion(preds: DataFrame, replicates: int = REPLICATES, label: str = S.LABEL, pred: str = "prediction",
                        rule: str = S.RULE, key: str = S.TX_ID, seed: int = SEED) -> DataFrame:
    """Per replicate: weighted TP, FN, FP, TN of the prediction and TP of the rule, for
    all replicates in one aggregate (a task sends one row per replicate).

    A row's digest is made once a replicate, from texts that are made once a row, and
    its count from the digest by the fewest steps.  There is no filter on the counts
    (a filter would make digest and count anew for each step); replicates in which no
    row is drawn go after the aggregate.  Equal rows are counted first, which also deals
    the rows evenly, as those of a scan may lie in few files."""
    y, p = F.col(label), F.col(pred)
    # as ``poisson_weight`` has it: a null key adds nothing to the text
    rows = preds.select(y.alias("y"), p.alias("p"), F.col(rule).alias("r"), F.concat_ws(":", F.lit(""), F.col(key).cast("string")).alias("k"))
    rows = rows.groupBy("k", "y", "p", "r").agg(F.count(F.lit(1)).alias("n")).withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    prefix = F.element_at(F.array(*[F.lit(f"{seed}:{i}") for i in range(1, replicates + 1)]), F.col("replicate"))
    rows = rows.withColumn("u", F.substring(F.md5(F.concat(prefix, F.col("k"))), 1, 8)).withColumn("w", _steps_passed(F.col("u")) * F.col("n"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("w"))), F.lit(0)).cast("long")
    return rows.groupBy("replicate").agg(
        total(F.expr("y = 1 AND p = 1")).alias("tp"), total(F.expr("y = 1 AND p = 0")).alias("fn"),
        total(F.expr("y = 0 AND p = 1")).alias("fp"), total(F.expr("y = 0 AND p = 0")).alias("tn"),
        total(F.expr("y = 1 AND r = 1")).alias("rule_tp"), F.sum("w").alias("drawn")).where("drawn > 0").drop("drawn")


def bootstrap_intervals(counts: DataFrame, level: int = 90) -> DataFrame:
    """(metric, low, median, high, replicates): intervals of ``level`` percent over the
    replicates of :func:`bootstrap_confusion`; ``model_vs_rule`` is the ratio of both
    recalls, over the replicates where the rule caught any."""
    tp, fn, fp, rule = (F.col(c) for c in ("tp", "fn", "fp", "rule_tp"))
    wide = counts.select(
        "replicate", _ratio0(tp, tp + fp).alias("precision"), _ratio0(tp, tp + fn).alias("recall"),
        _ratio0(rule, tp + fn).alias("rule_recall"),
        F.when(rule > 0, tp.cast("double") / rule.cast("double")).alias("model_vs_rule"))
    names = wide.columns[1:]
    long = wide.unpivot(["replicate"], names, "metric", "value").where("value IS NOT NULL")
    # replicates times metrics rows, a fixed number
    ranked = long.select("metric", "value", F.row_number().over(Window.partitionBy("metric").orderBy("value", "replicate")).alias("i"),
                         F.count(F.lit(1)).over(Window.partitionBy("metric")).alias("n"))
    # half percents, so that ranks are whole numbers
    rank = lambda q: F.greatest(F.lit(1), F.call_function("div", F.col("n") * q + 199, F.lit(200)))
    at = lambda q: F.max(F.when(F.col("i") == rank(q), F.col("value")))
    return ranked.groupBy("metric").agg(at(100 - level).alias("low"), at(100).alias("median"), at(100 + level).alias("high"),
                                        F.max("n").alias("replicates"))


# ---------------------------------------------------------------- permutation

RANK_HEX = 4


def digest_rank(df: DataFrame, salt: str, key: str = S.TX_ID, out: str = "rank") -> DataFrame:
    """``df`` with the place of each row in the order of ``md5(salt || key)``, from 0.

    Rows are counted by the first ``RANK_HEX`` digits of the digest, these at most
    16**RANK_HEX totals get a running sum, and rows are ranked within their digits
    only: no task orders the table."""
    h, b, base = (f"_{out}_{c}" for c in ("digest", "bucket", "base"))
    rows = (df.withColumn(h, F.md5(F.concat(F.lit(salt), F.coalesce(F.col(key).cast("string"), F.lit("")))))
            .withColumn(b, F.substring(h, 1, RANK_HEX)))
    before = Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(b).agg(F.count(F.lit(1)).alias(base)).withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    within = Window.partitionBy(b).orderBy(h, key)
    return (rows.withColumn(out, F.row_number().over(within) - 1).join(F.broadcast(totals), b)
            .withColumn(out, (F.col(out) + F.col(base)).cast("long")).drop(h, b, base))


def permuted(df: DataFrame, column: str, seed: int = SEED, key: str = S.TX_ID) -> DataFrame:
    """``df`` with the values of ``column`` dealt anew: the row at place i of one digest
    order gets the value of the row at place i of another, so every value is given
    away exactly once.  ``key`` must be unique; one join by rank, which has no hot key."""
    takes = digest_rank(df.drop(column), f"take-{seed}:", key, "_place")
    gives = digest_rank(df.select(key, column), f"give-{seed}:{column}:", key, "_place").select("_place", column)
    return takes.join(gives, "_place").select(*df.columns)


def permutation_importance(model, test: DataFrame, features, seed: int = SEED) -> DataFrame:
    """(feature, auc, auc_drop) of each feature permuted, scored without refit.  ``test``
    is written once; ``type_idx`` permutes the type behind it."""
    from txrisk.operators import metrics as M
    from txrisk.operators import model as ML
    from txrisk.session import discard, materialize

    def auc(rows: DataFrame) -> float:
        from pyspark.ml.functions import vector_to_array
        scored = model.transform(rows).withColumn("margin", vector_to_array("rawPrediction").getItem(1))
        return M.auc_exact(scored, score="margin").first()["auc"]

    rows = materialize(ML.model_inputs(test), "permutation")
    try:
        whole = auc(rows)
        found = [(f, auc(permuted(rows, S.TYPE if f == ML.TYPE_INDEX else f, seed))) for f in features]
    finally:
        discard(rows)
    return test.sparkSession.createDataFrame(
        [(f, a, whole - a) for f, a in found], "feature string, auc double, auc_drop double").orderBy(F.desc("auc_drop"), "feature")


# ------------------------------------------------------------- rolling origin

#: Fixed values of the registered folds: the last train step of each, and the steps
#: of a test window after it.
ORIGINS = (300, 400, 500, 600)
HORIZON = 100


def rolling_folds(df: DataFrame, origins=ORIGINS, horizon: int = HORIZON, step: str = S.STEP) -> DataFrame:
    """Rows by (fold, split): fold i trains on all steps up to ``origins[i]`` and tests
    on the ``horizon`` steps after it.  A row comes once per fold that it is in."""
    at = F.col(step)
    folds = F.array(*[F.struct(F.lit(i).alias("fold"), F.when(at <= o, "train").when(at <= o + horizon, "test").alias("split"))
                      for i, o in enumerate(origins, 1)])
    wanted = F.filter(folds, lambda f: f["split"].isNotNull())
    return df.withColumn("_f", F.explode(wanted)).select(*df.columns, "_f.fold", "_f.split")


def fold_counts(folds: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Rows, positives and the range of steps of each fold's parts."""
    return folds.groupBy("fold", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("positives"),
        F.min(S.STEP).alias("step_min"), F.max(S.STEP).alias("step_max"))


def rolling_origin(enriched: DataFrame, origins=ORIGINS, horizon: int = HORIZON, features=None, **gbt_params) -> DataFrame:
    """Fit once per fold and evaluate on its window: (fold, train_rows, test_rows,
    positives, auc, precision, recall, f1).  The rows are prepared and written once;
    every fold reads its steps from that table, with its own class weight, and the
    fits run from parallel threads."""
    from txrisk.operators import metrics as M
    from txrisk.operators import model as ML
    from txrisk.plans import stages
    from txrisk.session import discard, materialize

    features = list(features or ML.FULL_FEATURES)
    spark = enriched.sparkSession
    rows = materialize(ML.model_inputs(enriched.where(F.col(S.STEP) <= max(origins) + horizon)), "folds")
    try:
        trains = {o: ML.laid_out(ML.with_class_weight(rows.where(F.col(S.STEP) <= o))) for o in origins}
        models = stages.parallel_fits(spark, {o: (ML.build_pipeline(features, **gbt_params), t) for o, t in trains.items()})
        out = []
        for i, o in enumerate(origins, 1):
            test = rows.where((F.col(S.STEP) > o) & (F.col(S.STEP) <= o + horizon))
            scored = stages.score_once(models[o], test)
            m = M.prf(M.confusion(scored)).first()
            auc = M.auc_exact(scored, score=stages.MARGIN).first()["auc"]
            out.append((i, rows.where(F.col(S.STEP) <= o).count(), sum(m[c] for c in ("tp", "fn", "fp", "tn")), m["tp"] + m["fn"],
                        auc, m["precision"], m["recall"], m["f1"]))
            discard(scored)
    finally:
        discard(rows)
    return spark.createDataFrame(out, "fold int, train_rows long, test_rows long, positives long, auc double, "
                                      "precision double, recall double, f1 double")
