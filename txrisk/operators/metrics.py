"""Classification metrics on scored rows.

Counts are fused into one conditional aggregation (one job instead of one
per count).  AUC is computed exactly from ranks with a distributed prefix
sum; MLlib's evaluator is available as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.numeric import half_up_ratio
from txrisk.functions.vectors import positive_probability


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def confusion(preds: DataFrame, label: str = S.LABEL, pred="prediction") -> DataFrame:
    """TP, FN, FP, TN at the given 0/1 prediction, in one pass."""
    y, p = F.col(label), _c(pred)
    return preds.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def confusion_cells(conf: DataFrame) -> DataFrame:
    """The 2x2 confusion matrix in long form: (actual, predicted, n)."""
    long = conf.unpivot([], ["tp", "fn", "fp", "tn"], "cell", "n")
    return long.select(
        F.when(F.col("cell").isin("tp", "fn"), 1).otherwise(0).alias("actual"),
        F.when(F.col("cell").isin("tp", "fp"), 1).otherwise(0).alias("predicted"),
        F.col("n"),
    )


def _ratio0(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def prf(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1 from confusion counts; each is 0.0 when its
    denominator is 0."""
    tp, fn, fp = F.col("tp"), F.col("fn"), F.col("fp")
    out = conf.select("tp", "fn", "fp", "tn",
                      _ratio0(tp, tp + fp).alias("precision"),
                      _ratio0(tp, tp + fn).alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.when(p + r > 0, F.lit(2) * p * r / (p + r)).otherwise(F.lit(0.0)))


# --------------------------------------------------------------------------
# AUC


def auc_exact(df: DataFrame, label: str = S.LABEL, score="score",
              partitions: int | None = None) -> DataFrame:
    """Exact area under the ROC curve (Mann-Whitney, ties count one half),
    one row ``auc``; NULL without positives or negatives.

    Plan: scores are aggregated to one row per distinct score (map-side
    combined, so a hot score costs nothing extra), range-partitioned and
    sorted; each partition emits one summary row (Arrow batches through
    ``mapInPandas``, a per-partition running sum that the built-in window
    functions cannot express without a single-partition window); a window
    over the summary table -- one row per partition -- adds the negatives of
    all lower partitions.  Nothing passes through the driver.

    NaN scores count as one score above all others (Spark's order), whatever
    the partition count; NULL scores and labels are left out.
    """
    # Defined here so that cloudpickle ships it to the Python workers by
    # value: the workers need no copy of this package on their path.
    def _rank_sum_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One summary row per range partition of the distinct-score table,
        which arrives sorted by score: its number (partitions follow the score
        order), the positive and negative totals, and
        sum(pos * (2 * negatives_below_in_partition + neg))."""
        from pyspark import TaskContext

        seen = False
        pos_total = neg_total = partial = 0
        for b in batches:
            if b.empty:
                continue
            seen = True
            pos = b["pos"].to_numpy(dtype="int64")
            neg = b["neg"].to_numpy(dtype="int64")
            below = neg.cumsum() - neg + neg_total
            term = 2 * below + neg
            if pos.size and int(pos.max()) * int(term.max()) * pos.size < 2 ** 62:
                partial += int((pos * term).sum())
            else:  # exact fallback with Python integers
                partial += sum(int(a) * int(t) for a, t in zip(pos, term))
            pos_total += int(pos.sum())
            neg_total += int(neg.sum())
        if seen:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "pos": [pos_total], "neg": [neg_total],
                                "partial": pd.Series([partial], dtype=object)})

    s, y = _c(score).cast("double"), F.col(label)
    d = (df.where(s.isNotNull() & y.isNotNull())
           .groupBy(s.alias("score"))
           .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")))
    ranged = (d.repartitionByRange(partitions, "score") if partitions
              else d.repartitionByRange("score"))
    parts = ranged.sortWithinPartitions("score").mapInPandas(
        _rank_sum_partition, "part int, pos long, neg long, partial decimal(38,0)")
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(38,0)"
    with_before = parts.withColumn("_before", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    agg = with_before.agg(
        F.sum(F.col("partial") + F.col("pos").cast(big) * F.col("_before").cast(big) * 2).alias("_u2"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    den = (F.col("_p").cast(big) * F.col("_n").cast(big) * 2)
    return agg.select(F.when(F.col("_p") * F.col("_n") > 0,
                             F.col("_u2").cast("double") / den.cast("double")).alias("auc"))


def auc_evaluator(preds: DataFrame, label: str = S.LABEL,
                  raw: str = "rawPrediction") -> float:
    """MLlib's ``BinaryClassificationEvaluator`` (areaUnderROC), as the
    original workflow reports it.  Returns a driver-side float."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw,
                                       metricName="areaUnderROC")
    return ev.evaluate(preds)


# --------------------------------------------------------------------------
# Baseline comparison and error listings


def rule_baseline(test: DataFrame, label: str = S.LABEL, rule: str = S.RULE) -> DataFrame:
    """Recall of the rule flag on a split: fraud rows, flagged fraud, %."""
    return test.agg(
        F.count_if(F.col(label) == 1).alias("test_fraud"),
        F.count_if((F.col(label) == 1) & (F.col(rule) == 1)).alias("baseline_tp"),
    ).withColumn("baseline_recall_pct", half_up_ratio(F.col("baseline_tp") * 100, "test_fraud", 3))


def compare_to_rule(preds: DataFrame, label: str = S.LABEL, rule: str = S.RULE,
                    pred: str = "prediction") -> DataFrame:
    """Model recall vs rule recall on the same scored rows, and the factor
    (NULL when the rule caught nothing: the counts are reported instead)."""
    y = F.col(label)
    out = preds.agg(
        F.count_if(y == 1).alias("positives"),
        F.count_if((y == 1) & (F.col(pred) == 1)).alias("model_tp"),
        F.count_if((y == 1) & (F.col(rule) == 1)).alias("rule_tp"),
    )
    return out.select(
        "positives", "model_tp", "rule_tp",
        _ratio0(F.col("model_tp"), F.col("positives")).alias("model_recall"),
        _ratio0(F.col("rule_tp"), F.col("positives")).alias("rule_recall"),
        F.when(F.col("rule_tp") > 0, F.col("model_tp").cast("double") / F.col("rule_tp").cast("double"))
         .alias("improvement"),
    )


ERROR_COLUMNS = (S.TX_ID, S.STEP, S.TYPE, S.AMOUNT)


def errors(preds: DataFrame, kind: str, label: str = S.LABEL, pred="prediction",
           extra=(), n: int | None = None) -> DataFrame:
    """Missed fraud (``kind="fn"``: label 1, predicted 0) or false alarms
    (``"fp"``: label 0, predicted 1), ordered by ``tx_id``: every such row, or
    the first ``n`` (a per-task top n, no full sort)."""
    y, p = F.col(label), _c(pred)
    cond = (y == 1) & (p == 0) if kind == "fn" else (y == 0) & (p == 1)
    cols = [c for c in ERROR_COLUMNS if c in preds.columns] + list(extra)
    out = preds.where(cond).select(*cols).orderBy(S.TX_ID)
    return out if n is None else out.limit(n)


def score_histogram(preds: DataFrame, bins: int = 40, label: str = S.LABEL,
                    prob: str = "probability") -> DataFrame:
    """Histogram of P(fraud) in ``bins`` equal bins of [0, 1] by label
    (p = 1 falls in the last bin)."""
    p = positive_probability(prob) if prob == "probability" else F.col(prob)
    b = F.least(F.lit(bins - 1), F.floor(p * bins).cast("int"))
    return (preds.groupBy(label, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
                 .orderBy(label, "bin"))


# --------------------------------------------------------------------------
# Evaluation by amount band and decision-threshold cost

# Lower edges of the amount bands (the last band is open).
AMOUNT_BAND_EDGES = (0, 100, 1_000, 10_000, 100_000, 1_000_000)


def amount_band(amount: str = S.AMOUNT, edges=AMOUNT_BAND_EDGES) -> Column:
    """Index of the band ``[edges[i], edges[i+1])`` holding the amount;
    NULL for NULL or for amounts below the first edge."""
    a = F.col(amount)
    band = F.lit(None).cast("int")
    for i, e in enumerate(edges):
        band = F.when(a >= e, F.lit(i)).otherwise(band)
    return band


def metrics_by_band(preds: DataFrame, label: str = S.LABEL, pred="prediction",
                    amount: str = S.AMOUNT, edges=AMOUNT_BAND_EDGES) -> DataFrame:
    """Confusion counts, precision and recall per amount band, one pass."""
    y, p = F.col(label), _c(pred)
    lo = F.element_at(F.array(*[F.lit(float(e)) for e in edges]), F.col("band") + 1)
    hi = F.element_at(F.array(*[F.lit(float(e)) for e in edges[1:]], F.lit(None).cast("double")),
                      F.col("band") + 1)
    g = preds.groupBy(amount_band(amount, edges).alias("band")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
    )
    tp, fn, fp = F.col("tp"), F.col("fn"), F.col("fp")
    return g.select("band", lo.alias("band_lo"), hi.alias("band_hi"), "rows", "tp", "fn", "fp",
                    _ratio0(tp, tp + fp).alias("precision"), _ratio0(tp, tp + fn).alias("recall"))


def threshold_costs(preds: DataFrame, score="fraud_prob", label: str = S.LABEL,
                    cost_fn: float = 10.0, cost_fp: float = 1.0, grid: int = 100) -> DataFrame:
    """Cost of each decision threshold ``k / grid`` (k = 0 .. grid + 1) for a
    score in [0, 1]: a row is flagged when ``score * grid >= k``;
    cost = cost_fn * missed fraud + cost_fp * false alarms.

    The scores are counted per grid cell (at most grid + 1 rows, map-side
    combined); the per-threshold totals are running sums over that bounded
    table, so the data is read once."""
    s = _c(score).cast("double")
    # cells -1 (below every threshold) .. grid + 1 (above every threshold):
    # exact for scores outside [0, 1] too
    cell = F.least(F.lit(grid + 1), F.greatest(F.lit(-1), F.floor(s * grid))).cast("int")
    counts = (preds.where(s.isNotNull() & F.col(label).isNotNull())
                   .groupBy(cell.alias("k"))
                   .agg(F.count_if(F.col(label) == 1).alias("_pos"),
                        F.count_if(F.col(label) != 1).alias("_neg")))
    ks = preds.sparkSession.range(-1, grid + 2).select(F.col("id").cast("int").alias("k"))
    # counts has at most grid + 3 rows: a proven bound for the broadcast
    per_k = ks.join(F.broadcast(counts), "k", "left").na.fill(0, ["_pos", "_neg"])
    below = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    at_or_above = Window.orderBy("k").rowsBetween(0, Window.unboundedFollowing)
    out = per_k.select(
        "k",
        (F.col("k") / F.lit(float(grid))).alias("threshold"),
        F.coalesce(F.sum("_pos").over(below), F.lit(0)).cast("long").alias("fn"),
        F.coalesce(F.sum("_neg").over(at_or_above), F.lit(0)).cast("long").alias("fp"),
    )
    return (out.where(F.col("k") >= 0)
               .withColumn("cost", F.lit(cost_fn) * F.col("fn") + F.lit(cost_fp) * F.col("fp")))


def best_threshold(costs: DataFrame) -> DataFrame:
    """The threshold with the lowest cost (the lowest threshold on ties)."""
    return costs.orderBy("cost", "k").limit(1)


def exact_best_threshold(preds: DataFrame, score="fraud_prob", label: str = S.LABEL,
                         cost_fn: float = 10.0, cost_fp: float = 1.0,
                         partitions: int | None = None) -> DataFrame:
    """The decision threshold of lowest cost among all distinct scores (a row
    is flagged when ``score >= threshold``), or a NULL threshold where flagging
    nothing is cheaper; the lowest threshold on ties.  One row: threshold, fn,
    fp, cost; no row for an empty input.  NULL and NaN scores are left out.

    Scores are aggregated to one row per distinct score and range-partitioned.
    What lies in lower partitions adds the same amount to the cost of every
    threshold of a partition, so each partition emits its own best threshold,
    and a window over these (one row per partition) adds the rest.
    """
    def _best_of_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        best, pos_total, neg_total = None, 0, 0
        for b in batches:
            if b.empty:
                continue
            pos, neg = b["pos"].to_numpy(dtype="int64"), b["neg"].to_numpy(dtype="int64")
            fn = pos.cumsum() - pos + pos_total
            spared = neg.cumsum() - neg + neg_total
            cost = cost_fn * fn - cost_fp * spared
            i = int(cost.argmin())
            if best is None or cost[i] < best[0]:
                best = (float(cost[i]), float(b["score"].iloc[i]), int(fn[i]), int(spared[i]))
            pos_total += int(pos.sum())
            neg_total += int(neg.sum())
        if best:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "threshold": [best[1]],
                                "fn": [best[2]], "spared": [best[3]], "pos": [pos_total], "neg": [neg_total]})

    s, y = _c(score).cast("double"), F.col(label)
    d = (preds.where(s.isNotNull() & ~F.isnan(s) & y.isNotNull()).groupBy(s.alias("score"))
              .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")))
    ranged = d.repartitionByRange(partitions, "score") if partitions else d.repartitionByRange("score")
    parts = ranged.sortWithinPartitions("score").mapInPandas(
        _best_of_partition, "part int, threshold double, fn long, spared long, pos long, neg long")
    lower = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    before = lambda c: F.coalesce(F.sum(c).over(lower), F.lit(0))
    found = parts.select("threshold", (F.col("fn") + before("pos")).alias("fn"),
                         (F.sum("neg").over(every) - F.col("spared") - before("neg")).alias("fp"),
                         F.sum("pos").over(every).alias("_p"))
    none = F.struct(F.lit(None).cast("double").alias("threshold"), F.col("_p").alias("fn"),
                    F.lit(0).cast("long").alias("fp"))
    own = F.struct("threshold", F.col("fn").cast("long").alias("fn"), F.col("fp").cast("long").alias("fp"))
    # each row also offers the threshold above all scores; all of these offers are alike
    cost = (F.lit(cost_fn) * F.col("fn") + F.lit(cost_fp) * F.col("fp")).alias("cost")
    return (found.select(F.explode(F.array(own, none)).alias("x")).select("x.*")
                 .select("threshold", "fn", "fp", cost)
                 .orderBy("cost", F.asc_nulls_last("threshold")).limit(1))
