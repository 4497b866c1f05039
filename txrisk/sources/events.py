"""Adapter: the shared ``events`` table read as transactions.

The test data has no transaction table; ``events`` (event_id, ts, user_id,
event_type, value, props) is mapped row by row onto the transaction schema
with a deterministic rule, so every query reads the given tables and grows
with them.  The rule is a pure projection (no shuffle); filters on ``type``
are translated back to ``event_type`` and reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.numeric import money_from_cents as _money

# Event type -> transaction type; anything else is DEBIT.
EVENT_TYPE_TO_TX_TYPE = {
    "purchase": "TRANSFER",
    "click": "CASH_OUT",
    "view": "PAYMENT",
    "signup": "CASH_IN",
}
OTHER_TX_TYPE = "DEBIT"

# Fixed values of the mapping rule (all amounts in cents).
FRAUD_MULTIPLIER = 7919
FRAUD_MODULUS = 1000
FRAUD_BASE_EARLY = 20
FRAUD_BASE_LATE = 60
FRAUD_BIG_BONUS = 100
FRAUD_BIG_CENTS = 10000
FLAG_CENTS = 15000
ORIG_BALANCE_MULTIPLIER = 104729
ORIG_BALANCE_MODULUS = 20000
DEST_USER_MULTIPLIER = 3100
DEST_STEP_MULTIPLIER = 17
DEST_BALANCE_MODULUS = 100000
ORIGIN_REUSE_MODULUS = 20
ORIGIN_OFFSET = 1000000
EPOCH = date(2024, 1, 1)


# Declared schema of the ``events`` table (no inference pass per read).
EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def utc_instant(col: str) -> Column:
    """A TIMESTAMP_NTZ wall-clock value read as UTC, as a TIMESTAMP (an
    instant); independent of the session time zone."""
    ts = F.col(col)
    return F.make_timestamp_ltz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.minute(ts), F.date_part(F.lit("SECOND"), ts), F.lit("UTC"))


def step_of(col: str) -> Column:
    """Hours since 2024-01-01 00:00 plus 1 of a wall-clock value, so that two
    years never share a step."""
    ts = F.col(col)
    return (F.datediff(ts.cast("date"), F.lit(EPOCH)) * 24 + F.hour(ts) + 1).cast("int")


def step_source_predicate(step_lo: int | None, step_hi: int | None) -> Column:
    """``step_lo <= step <= step_hi`` as a range on the raw ``ts`` column, so
    that Parquet skips row groups outside of it."""
    def begin(step: int) -> Column:
        t = datetime.combine(EPOCH, datetime.min.time()) + timedelta(hours=step - 1)
        return F.make_timestamp_ntz(F.lit(t.year), F.lit(t.month), F.lit(t.day), F.lit(t.hour), F.lit(0), F.lit(0))
    pred = F.lit(True)
    if step_lo is not None:
        pred = F.col("ts") >= begin(step_lo)
    if step_hi is not None:
        pred = pred & (F.col("ts") < begin(step_hi + 1))
    return pred


def type_source_predicate(types: Iterable[str]) -> Column:
    """``type IN types`` expressed on the raw ``event_type`` column."""
    types = set(types)
    wanted = [e for e, t in EVENT_TYPE_TO_TX_TYPE.items() if t in types]
    pred = F.col("event_type").isin(wanted) if wanted else F.lit(False)
    if OTHER_TX_TYPE in types:
        known = list(EVENT_TYPE_TO_TX_TYPE)
        pred = pred | F.col("event_type").isNull() | ~F.col("event_type").isin(known)
    return pred


def events_to_transactions(events: DataFrame, event_time: str | None = None) -> DataFrame:
    """Project ``events`` onto the transaction schema (see ``FIXTURES.md``).

    ``event_time``: also keep ``ts`` as a TIMESTAMP column of that name,
    reading its wall-clock value as UTC whatever the session time zone (the
    event-time column for streaming).  Works on streaming DataFrames too.

    Two projections: the first derives step, type, cents and the label once;
    the second builds the balances from them.  Both stay in one codegen stage.
    """
    tx_type = F.lit(OTHER_TX_TYPE)
    for ev, tx in reversed(list(EVENT_TYPE_TO_TX_TYPE.items())):
        tx_type = F.when(F.col("event_type") == ev, tx).otherwise(tx_type)
    base = events.select(
        F.col("event_id").alias(S.TX_ID),
        step_of("ts").alias(S.STEP),
        tx_type.alias(S.TYPE),
        F.round(F.col("value") * 100).cast("long").alias("_c"),
        F.col("user_id").alias("_uid"),
        *([utc_instant("ts").alias(event_time)] if event_time else []),
    )
    eid, uid, step, c, typ = (F.col(S.TX_ID), F.col("_uid"), F.col(S.STEP),
                              F.col("_c"), F.col(S.TYPE))
    threshold = (F.when(step > S.SPLIT_STEP, FRAUD_BASE_LATE).otherwise(FRAUD_BASE_EARLY)
                 + F.when(c > FRAUD_BIG_CENTS, FRAUD_BIG_BONUS).otherwise(0))
    fraud = F.when(typ.isin(*S.RISKY_TYPES)
                   & ((eid * FRAUD_MULTIPLIER) % FRAUD_MODULUS < threshold), 1).otherwise(0)
    labelled = base.withColumn(S.LABEL, fraud.cast("int"))

    f = F.col(S.LABEL)
    ob = F.when(f == 1, c).otherwise((eid * ORIG_BALANCE_MULTIPLIER) % ORIG_BALANCE_MODULUS)
    od = (uid * DEST_USER_MULTIPLIER + step * DEST_STEP_MULTIPLIER) % DEST_BALANCE_MODULUS
    dest_unchanged = ((f == 1) & (eid % 2 == 0)) | ((f == 0) & (eid % 10 == 0))
    origin = F.when(eid % ORIGIN_REUSE_MODULUS == 0, uid).otherwise(ORIGIN_OFFSET + eid)
    return labelled.select(
        eid.alias(S.TX_ID),
        step.alias(S.STEP),
        typ.alias(S.TYPE),
        _money(c).alias(S.AMOUNT),
        F.concat(F.lit("C"), origin.cast("string")).alias(S.ORIG),
        _money(ob).alias(S.OLD_ORIG),
        _money(F.greatest(ob - c, F.lit(0))).alias(S.NEW_ORIG),
        F.concat(F.lit("M"), uid.cast("string")).alias(S.DEST),
        _money(od).alias(S.OLD_DEST),
        _money(F.when(dest_unchanged, od).otherwise(od + c)).alias(S.NEW_DEST),
        f.alias(S.LABEL),
        F.when((typ == "TRANSFER") & (c > FLAG_CENTS), 1).otherwise(0).cast("int").alias(S.RULE),
        *([F.col(event_time)] if event_time else []),
    )


def load_transactions(spark: SparkSession, sf_dir: str,
                      types: Iterable[str] | None = None,
                      event_time: str | None = None, step_lo: int | None = None,
                      step_hi: int | None = None) -> DataFrame:
    """Transactions for a test-data directory.  ``types`` restricts the
    transaction types at the scan (the equivalent of partition pruning on
    the type-partitioned layout), ``step_lo`` and ``step_hi`` the steps (both
    included); ``event_time`` keeps the event instant."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    if types:
        events = events.where(type_source_predicate(types))
    if step_lo is not None or step_hi is not None:
        events = events.where(step_source_predicate(step_lo, step_hi))
    return events_to_transactions(events, event_time=event_time)
