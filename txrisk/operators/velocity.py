"""Rolling per-key velocity over a value-range frame.

Semantics (kept from the original workflow): for each row, the count and the amount
sum of rows with the same key whose order value lies in
``[order - lookback, order]`` -- a closed frame covering ``lookback + 1``
values, including every peer in the same step.  NULL keys form one group;
rows with a NULL order value see only each other.

Plan: the rows are first aggregated to one row per (key, step); the range
window runs over that table, and the result is joined back to the rows on
(key, step) with null-safe equality.  A key that holds a large share of all
rows therefore costs one row per distinct step in the window (the window
never sorts a hot key's raw rows in a single task), the pre-aggregation is
combined map-side, and the join back is a many-to-one equi-join that AQE
can split when one (key, step) is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk import schema as S


def free_name(base: str, *taken: str) -> str:
    """``base``, or ``base`` with a number that no name in ``taken`` has."""
    used = {c.lower() for c in taken}
    name, i = base, 0
    while name.lower() in used:
        i += 1
        name = f"{base}{i}"
    return name


def step_totals(df: DataFrame, key: str = S.DEST, order: str = S.STEP,
                value: str = S.AMOUNT) -> DataFrame:
    """One row per (key, order value): row count and value sum."""
    return df.groupBy(key, order).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))


def rolling_totals(df: DataFrame, key: str = S.DEST, order: str = S.STEP,
                   value: str = S.AMOUNT, lookback: int = S.LOOKBACK_STEPS,
                   count_col: str = S.VELOCITY_COUNT, sum_col: str = S.VELOCITY_AMOUNT,
                   exclude_current: bool = False) -> DataFrame:
    """Per (key, order value): totals over the trailing range frame."""
    hi = -1 if exclude_current else 0
    w = Window.partitionBy(key).orderBy(order).rangeBetween(-lookback, hi)
    return step_totals(df, key, order, value).select(
        key, order,
        F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("long").alias(count_col),
        F.sum("_s").over(w).alias(sum_col),
    )


def with_velocity(df: DataFrame, key: str = S.DEST, order: str = S.STEP,
                  value: str = S.AMOUNT, lookback: int = S.LOOKBACK_STEPS,
                  count_col: str = S.VELOCITY_COUNT, sum_col: str = S.VELOCITY_AMOUNT,
                  exclude_current: bool = False) -> DataFrame:
    """``df`` plus the rolling count and sum columns.

    ``exclude_current=True`` uses the frame ``[order - lookback, order - 1]``
    (strictly earlier steps); the default keeps the original frame."""
    rolled = rolling_totals(df, key, order, value, lookback, count_col, sum_col,
                            exclude_current)
    rk = free_name("_vk", *df.columns, *rolled.columns)
    ro = free_name("_vo", *df.columns, *rolled.columns)
    rolled = rolled.withColumnRenamed(key, rk).withColumnRenamed(order, ro)
    cond = [df[key].eqNullSafe(rolled[rk]), df[order].eqNullSafe(rolled[ro])]
    return df.join(rolled, cond, "inner").drop(rk, ro)
