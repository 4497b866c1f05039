"""Account-level features and destination profiles.

All of these group by an account key.  Spark combines each aggregate
map-side (partial aggregation), so an account that receives a third of all
rows sends one partial row per task through the shuffle, not its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.numeric import cents, half_up_ratio, sample_stddev_cents


#: How the columns of an account state merge: sums, and one maximum.
_SUMS = {"tx_count": "bigint", "total_sent": "decimal(28,2)", "amounts": "bigint", "squares": "decimal(38,0)",
         "transfer_count": "bigint", "cashout_count": "bigint", "fraud_count": "bigint", "balance_sum": "decimal(28,2)",
         "balances": "bigint", "zero_balance_count": "bigint"}


def account_state(risky: DataFrame, key: str = S.ORIG) -> DataFrame:
    """One row per account of counts, exact sums, squares of cents and a maximum:
    all that :func:`features_of_state` needs, and all of it merges.

    The sum of cents is the total times 100, and only the square needs the wide
    type."""
    c = cents(S.AMOUNT).cast("decimal(18,0)")
    return risky.groupBy(key).agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum(S.AMOUNT).alias("total_sent"),
        F.count(S.AMOUNT).alias("amounts"),
        F.max(S.AMOUNT).alias("max_amount"),
        F.sum(c * c).alias("squares"),
        F.sum(F.when(F.col(S.TYPE) == "TRANSFER", 1).otherwise(0)).cast("long").alias("transfer_count"),
        F.sum(F.when(F.col(S.TYPE) == "CASH_OUT", 1).otherwise(0)).cast("long").alias("cashout_count"),
        F.sum(S.LABEL).cast("long").alias("fraud_count"),
        F.sum(S.OLD_ORIG).alias("balance_sum"),
        F.count(S.OLD_ORIG).alias("balances"),
        F.sum(F.when(F.col(S.NEW_ORIG) == 0, 1).otherwise(0)).cast("long").alias("zero_balance_count"),
    )


def merge_states(*states: DataFrame, key: str = S.ORIG) -> DataFrame:
    """The state of all rows behind ``states``.  One shuffle of one row per account
    and state; a hot account costs no more than any other."""
    rows = states[0]
    for s in states[1:]:
        rows = rows.unionByName(s)
    return rows.groupBy(key).agg(F.max("max_amount").alias("max_amount"),
                                 *[F.sum(c).cast(t).alias(c) for c, t in _SUMS.items()])


def features_of_state(state: DataFrame, key: str = S.ORIG) -> DataFrame:
    """Ten aggregates per origin account plus the account-level label.

    Means are HALF_UP-rounded from exact sums, the standard deviation is the
    sample one (NULL for a single row) from exact integer moments."""
    return state.select(
        key, "tx_count",
        F.col("total_sent"),
        half_up_ratio("total_sent", "amounts", 2, num_scale=2).alias("avg_amount"),
        F.col("max_amount"),
        sample_stddev_cents("amounts", F.col("total_sent") * 100, "squares").alias("amount_stddev"),
        "transfer_count", "cashout_count", "fraud_count",
        half_up_ratio("balance_sum", "balances", 2, num_scale=2).alias("avg_balance_before"),
        "zero_balance_count",
        (F.col("fraud_count") > 0).cast("int").alias("is_fraud_customer"),
    )


def customer_features(risky: DataFrame, key: str = S.ORIG) -> DataFrame:
    """:func:`features_of_state` of the rows themselves."""
    return features_of_state(account_state(risky, key), key)


def top_customers(features: DataFrame, n: int = 10, key: str = S.ORIG) -> DataFrame:
    """Top ``n`` accounts by amount sent (ties by account)."""
    return features.orderBy(F.desc_nulls_last("total_sent"), F.asc_nulls_last(key)).limit(n)


def customer_profile(features: DataFrame) -> DataFrame:
    """Fraud vs legit accounts: count and means of per-account values (means
    of the rounded per-account figures, as the original report defines them).
    Totals stay the exact decimals that ``customer_features`` returns."""
    money = lambda c: F.col(c).cast("decimal(28,2)")  # noqa: E731 - 2-dp values
    return features.groupBy("is_fraud_customer").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("tx_count").alias("_tc"), F.count("tx_count").alias("_tcn"),
        F.sum(money("total_sent")).alias("_ts"), F.count("total_sent").alias("_tsn"),
        F.sum(money("avg_amount")).alias("_aa"), F.count("avg_amount").alias("_aan"),
        F.sum("zero_balance_count").alias("_zb"), F.count("zero_balance_count").alias("_zbn"),
    ).select(
        "is_fraud_customer", "customer_count",
        half_up_ratio("_tc", "_tcn", 2).alias("avg_tx_count"),
        half_up_ratio("_ts", "_tsn", 2, num_scale=2).alias("avg_total_sent"),
        half_up_ratio("_aa", "_aan", 2, num_scale=2).alias("avg_tx_amount"),
        half_up_ratio("_zb", "_zbn", 2).alias("avg_account_drains"),
    )


def dest_frequency(risky: DataFrame, key: str = S.DEST) -> DataFrame:
    """Per destination: times received, total received, fraud received."""
    return risky.groupBy(key).agg(
        F.count(F.lit(1)).alias("times_received"),
        F.sum(S.AMOUNT).alias("total_received"),
        F.sum(S.LABEL).cast("long").alias("fraud_received"),
    )


def dest_reuse_histogram(dest_freq: DataFrame, n: int = 10) -> DataFrame:
    """How many destinations were hit k times; the ``n`` most common k."""
    return (dest_freq.groupBy("times_received").agg(F.count(F.lit(1)).alias("count"))
                     .orderBy(F.desc("count"), F.asc("times_received"))
                     .limit(n))


def fraud_destinations(dest_freq: DataFrame, n: int = 10, key: str = S.DEST) -> DataFrame:
    """Destinations that received any fraud, most used first (HAVING + top n)."""
    return (dest_freq.where(F.col("fraud_received") > 0)
                     .orderBy(F.desc("times_received"), F.asc_nulls_last(key))
                     .limit(n))


def merge_dest_frequency(*tables: DataFrame, key: str = S.DEST) -> DataFrame:
    """:func:`dest_frequency` of all rows behind ``tables``: its columns add up."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    return rows.groupBy(key).agg(F.sum("times_received").alias("times_received"),
                                 F.sum("total_received").cast("decimal(28,2)").alias("total_received"),
                                 F.sum("fraud_received").alias("fraud_received"))


def update_state(path: str, new: DataFrame, version: int, merge=merge_states) -> DataFrame:
    """Merge the state of new rows into the stored one and return it.

    The state after batch ``version`` is a folder of its own, made from the newest
    earlier one, so a batch that is run again replaces its result and counts its
    rows once.  Versions only grow; drop old ones when no batch before them will
    be repeated."""
    spark = new.sparkSession
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    have = []
    if fs.exists(base):
        for f in fs.listStatus(base):
            name, _, number = f.getPath().getName().partition("=")
            done = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))
            if name == "version" and done and int(number) < version:
                have.append(int(number))
    stored = [spark.read.parquet(f"{path.rstrip('/')}/version={max(have)}")] if have else []
    out = f"{path.rstrip('/')}/version={version}"
    merge(*stored, new).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)
