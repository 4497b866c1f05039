"""Profiles of a transaction table or a slice of it.

Every profile is one aggregation: scalar counts are fused into a single
``agg`` pass instead of one job per number, and grouped profiles combine
map-side before the shuffle, so a hot group costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.numeric import half_up_ratio
from txrisk.operators.filters import risky as risky_filter
from txrisk.operators.filters import time_split


def _distinct(col: str, count_null: bool, approx: bool):
    base = F.approx_count_distinct(col) if approx else F.count_distinct(F.col(col))
    if not count_null:
        return base
    # DataFrame.distinct().count() counts a NULL key as one more value.
    return base + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))


def overview(tx: DataFrame, count_null: bool = True, approx: bool = False) -> DataFrame:
    """Row count and distinct origins / destinations, one pass."""
    return tx.agg(
        F.count(F.lit(1)).alias("tx_count"),
        _distinct(S.ORIG, count_null, approx).cast("long").alias("origins"),
        _distinct(S.DEST, count_null, approx).cast("long").alias("destinations"),
    )


def volume_by_type(tx: DataFrame) -> DataFrame:
    """Per type: rows, total amount, mean amount (2 dp); by total desc."""
    return (tx.groupBy(S.TYPE)
              .agg(F.count(F.lit(1)).alias("tx_count"),
                   F.sum(S.AMOUNT).alias("total_amount"),
                   F.count(S.AMOUNT).alias("_n"))
              .select(S.TYPE, "tx_count", "total_amount",
                      half_up_ratio("total_amount", "_n", 2, num_scale=2).alias("avg_amount"))
              .orderBy(F.desc_nulls_last("total_amount"), S.TYPE))


def fraud_rate_by_type(tx: DataFrame) -> DataFrame:
    """Per type: rows, fraud rows, fraud rate in percent (4 dp); by rate desc."""
    return (tx.groupBy(S.TYPE)
              .agg(F.count(F.lit(1)).alias("total"),
                   F.sum(S.LABEL).cast("long").alias("fraud_count"))
              .withColumn("fraud_rate_pct",
                          half_up_ratio(F.col("fraud_count") * 100, "total", 4))
              .orderBy(F.desc_nulls_last("fraud_rate_pct"), S.TYPE))


def rule_recall(tx: DataFrame, label: str = S.LABEL, rule: str = S.RULE) -> DataFrame:
    """Fraud rows, fraud rows the rule flagged, and the rule's recall (%)."""
    return tx.agg(
        F.count_if(F.col(label) == 1).alias("total_fraud"),
        F.count_if((F.col(label) == 1) & (F.col(rule) == 1)).alias("flagged_fraud"),
    ).withColumn("recall_pct", half_up_ratio(F.col("flagged_fraud") * 100, "total_fraud", 2))


def kpis(view: DataFrame) -> DataFrame:
    """KPI row of a slice: rows, fraud, fraud % (3 dp), distinct accounts.
    A slice without labelled rows has a fraud rate of 0."""
    return view.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.coalesce(F.sum(S.LABEL), F.lit(0)).cast("long").alias("fraud_cases"),
        F.count(S.LABEL).alias("_n"),
        F.count_distinct(F.col(S.ORIG)).alias("origins"),
        F.count_distinct(F.col(S.DEST)).alias("destinations"),
    ).select("transactions", "fraud_cases",
             F.coalesce(half_up_ratio(F.col("fraud_cases") * 100, "_n", 3), F.lit(0.0))
              .alias("fraud_rate_pct"),
             "origins", "destinations")


def activity_by_step(view: DataFrame) -> DataFrame:
    """Per step: transactions (rows with an amount) and fraud rows."""
    return (view.groupBy(S.STEP)
                .agg(F.count(S.AMOUNT).alias("transactions"),
                     F.sum(S.LABEL).cast("long").alias("fraud"))
                .orderBy(S.STEP))


def top_destinations(view: DataFrame, n: int = 10,
                     types=S.RISKY_TYPES) -> DataFrame:
    """The ``n`` destinations with most incoming risky-type transactions in a
    slice (ties by name).  Spark plans ``TakeOrderedAndProject``: each task
    keeps its own top ``n``, so no full sort is needed."""
    return (risky_filter(view, types)
            .groupBy(S.DEST)
            .agg(F.count(S.AMOUNT).alias("times_received"),
                 F.sum(S.AMOUNT).alias("total_received"),
                 F.sum(S.LABEL).cast("long").alias("fraud_received"))
            .orderBy(F.desc("times_received"), F.asc_nulls_last(S.DEST))
            .limit(n))


def log_amount_micros(amount: str = S.AMOUNT):
    """``log10(amount + 1)`` in millionths, rounded to an integer, so the
    bin edges are exact integers and do not move with the last ulp."""
    return F.round(F.log10(F.col(amount).cast("double") + F.lit(1.0)) * F.lit(1e6)).cast("long")


def amount_histogram(view: DataFrame, bins: int = 60, label: str = S.LABEL) -> DataFrame:
    """Equal-width histogram of ``log10(amount + 1)`` by label.

    The range is taken over all labels of the slice (shared edges); bin
    ``k`` covers ``[lo + k*w, lo + (k+1)*w)`` with the maximum in the last
    bin.  The bounds are two scalar subqueries, not a driver round trip."""
    v = view.where(F.col(S.AMOUNT).isNotNull()).select(label, log_amount_micros().alias("_v"))
    lo = v.agg(F.min("_v")).scalar()
    hi = v.agg(F.max("_v")).scalar()
    width = (hi - lo).cast("long")
    k = F.when(width > 0,
               F.least(F.lit(bins - 1).cast("long"),
                       F.call_function("div", (F.col("_v") - lo) * bins, width))
               ).otherwise(F.lit(0).cast("long"))
    edge = lambda j: ((lo * bins + j * width).cast("double") / F.lit(bins * 1e6))
    return (v.groupBy(label, k.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
             .select(label, "bin", edge(F.col("bin")).alias("bin_lo"),
                     edge(F.col("bin") + 1).alias("bin_hi"), "count")
             .orderBy(label, "bin"))


def positive_rate(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Rows, positives and positive rate (%, 3 dp) of a whole table."""
    return (df.agg(F.count(F.lit(1)).alias("rows"),
                   F.count_if(F.col(label) == 1).alias("positives"))
              .withColumn("positive_rate_pct", half_up_ratio(F.col("positives") * 100, "rows", 3)))


def split_summary(df: DataFrame, split_step: int = S.SPLIT_STEP, label: str = S.LABEL) -> DataFrame:
    """Rows, positives and positive rate (%, 3 dp) of the train and test
    parts of the time split, in one pass."""
    return (time_split(df, split_step)
            .groupBy("split")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col(label) == 1).alias("positives"))
            .withColumn("positive_rate_pct", half_up_ratio(F.col("positives") * 100, "rows", 3)))
