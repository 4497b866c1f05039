"""Filters, slices and the time split."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S


def risky(tx: DataFrame, types: Iterable[str] = S.RISKY_TYPES, col: str = S.TYPE) -> DataFrame:
    """Rows of the given transaction types.  On the type-partitioned layout
    this becomes a ``PartitionFilters`` entry and prunes folders."""
    return tx.where(F.col(col).isin(list(types)))


def slice_tx(tx: DataFrame, types: Iterable[str] | None = None,
             step_lo: int | None = None, step_hi: int | None = None,
             fraud_only: bool = False, step: str = S.STEP, label: str = S.LABEL,
             type_col: str = S.TYPE) -> DataFrame:
    """Interactive slice: a type set, a closed step interval and a
    label-only switch.  An empty or missing type set means all types."""
    out = tx
    types = list(types or [])
    if types:
        out = out.where(F.col(type_col).isin(types))
    if step_lo is not None:
        out = out.where(F.col(step) >= step_lo)
    if step_hi is not None:
        out = out.where(F.col(step) <= step_hi)
    if fraud_only:
        out = out.where(F.col(label) == 1)
    return out


def slice_domain(tx: DataFrame, step: str = S.STEP, type_col: str = S.TYPE) -> DataFrame:
    """Bounds for the slice controls: sorted distinct types, min/max step.

    ``collect_set`` keeps one entry per distinct type per partial aggregate,
    so its size is bounded by the type domain, not by the row count."""
    return tx.agg(
        F.sort_array(F.collect_set(type_col)).alias("types"),
        F.min(step).alias("step_min"),
        F.max(step).alias("step_max"),
    )


def slice_summary(view: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Rows and fraud rows of a slice, in one pass."""
    return view.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("fraud"),
    )


def time_split(df: DataFrame, split_step: int = S.SPLIT_STEP, step: str = S.STEP,
               out: str = "split") -> DataFrame:
    """Label each row ``train`` (step <= split) or ``test`` (step > split);
    rows with a NULL step land in neither and are dropped, as the pair of
    complementary filters would do."""
    return (df.where(F.col(step).isNotNull())
              .withColumn(out, F.when(F.col(step) <= split_step, "train").otherwise("test")))


def train_test(df: DataFrame, split_step: int = S.SPLIT_STEP, step: str = S.STEP):
    """The two complementary step filters (pushed down to the scan)."""
    return (df.where(F.col(step) <= split_step), df.where(F.col(step) > split_step))
