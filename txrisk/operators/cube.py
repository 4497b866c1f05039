"""Stored summaries that answer any slice of type and step: exact running sums
(P6, P8, A13, A14) and mergeable distinct-count sketches (A2, A13)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.numeric import half_up_ratio

#: Counted per cell: rows, rows with an amount, fraud rows, rows with a label.
MEASURES = ("rows", "amounts", "fraud", "labelled")


def slice_cube(tx: DataFrame, type_col: str = S.TYPE, step: str = S.STEP) -> DataFrame:
    """(type, step, measures, and their running sums ``upto_*`` over the steps of the
    type), dense: a row for every step between the first and the last of the table.

    Its size is types times steps, whatever the rows.  Rows without a step are in no
    closed range; they have one row per type with a null step and no running sum."""
    cells = tx.groupBy(F.col(type_col).alias("type"), F.col(step).cast("long").alias("step")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(S.AMOUNT).alias("amounts"),
        F.coalesce(F.sum(S.LABEL), F.lit(0)).cast("long").alias("fraud"), F.count(S.LABEL).alias("labelled"))
    known = cells.where("step IS NOT NULL")
    bounds = known.agg(F.min("step").alias("lo"), F.max("step").alias("hi")).select(F.struct("lo", "hi")).scalar()
    grid = cells.select("type").distinct().select(
        "type", F.explode(F.sequence(bounds.getField("lo"), bounds.getField("hi"))).alias("step"))
    zero = {m: 0 for m in MEASURES}
    same = [F.col("g.type").eqNullSafe(F.col("c.type")), F.col("g.step") == F.col("c.step")]
    dense = (grid.alias("g").join(known.alias("c"), same, "left").select("g.type", "g.step", *MEASURES).fillna(zero, list(MEASURES)))
    w = Window.partitionBy("type").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    upto = dense.select("type", "step", *MEASURES, *[F.sum(m).over(w).alias(f"upto_{m}") for m in MEASURES])
    return upto.unionByName(cells.where("step IS NULL"), allowMissingColumns=True)


def cube_slices(cube: DataFrame, slices: DataFrame) -> DataFrame:
    """The measures of closed step ranges: ``slices`` has (type, step_lo, step_hi), no
    nulls, and gets them as the difference of two running sums, found by equality.
    Ranges may reach beyond the table."""
    bounds = (cube.where("step IS NOT NULL").groupBy("type").agg(F.min("step").alias("lo"), F.max("step").alias("hi")))
    asked = slices.join(F.broadcast(bounds), "type", "left")  # a row per type
    at = {"hi_at": F.least(F.col("step_hi").cast("long"), F.col("hi")), "lo_at": F.least(F.col("step_lo").cast("long") - 1, F.col("hi"))}
    asked = asked.withColumns(at)
    for side in ("hi", "lo"):
        cells = cube.where("step IS NOT NULL").select(
            F.col("type"), F.col("step").alias(f"{side}_at"), *[F.col(f"upto_{m}").alias(f"{side}_{m}") for m in MEASURES])
        asked = asked.join(cells, ["type", f"{side}_at"], "left")
    inside = F.col("step_lo") <= F.col("step_hi")
    value = lambda m: F.when(inside, F.coalesce(f"hi_{m}", F.lit(0)) - F.coalesce(f"lo_{m}", F.lit(0))).otherwise(0)
    return asked.select(*slices.columns, *[value(m).cast("long").alias(m) for m in MEASURES])


def cube_kpis(cube: DataFrame, types: Iterable[str] | None = None, step_lo: int | None = None,
              step_hi: int | None = None) -> DataFrame:
    """Rows, fraud and fraud rate of one slice, as :func:`profile.kpis` has them.  No
    types means all of them (a null type too); without both bounds rows without a
    step count too."""
    types = list(types or [])
    part = cube.where(F.col("type").isin(types)) if types else cube
    open_ = step_lo is None and step_hi is None
    keep = F.col("step").isNull() if open_ else F.lit(False)
    within = F.col("step").isNotNull()
    if step_lo is not None:
        within = within & (F.col("step") >= step_lo)
    if step_hi is not None:
        within = within & (F.col("step") <= step_hi)
    # the running sums at both ends of the range, per type
    ends = part.where(within).groupBy("type").agg(
        *[(F.max_by(f"upto_{m}", "step") - F.min_by(F.col(f"upto_{m}") - F.col(m), "step")).alias(m) for m in MEASURES])
    total = ends.unionByName(part.where(keep).select("type", *MEASURES)).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in MEASURES])
    rate = F.coalesce(half_up_ratio(F.col("fraud") * 100, "labelled", 3), F.lit(0.0))
    return total.select(F.col("rows").alias("transactions"), F.col("fraud").alias("fraud_cases"), rate.alias("fraud_rate_pct"))


def cube_activity(cube: DataFrame, types: Iterable[str] | None = None) -> DataFrame:
    """Per step, transactions with an amount and fraud rows; steps without rows left out."""
    types = list(types or [])
    part = cube.where(F.col("type").isin(types)) if types else cube
    return (part.groupBy(F.col("step").cast("int").alias(S.STEP))
            .agg(F.sum("rows").alias("n"), F.sum("amounts").alias("transactions"), F.sum("fraud").alias("fraud"))
            .where("n > 0").drop("n").orderBy(S.STEP))


#: log2 of the registers of a distinct-count sketch, and the relative error that an
#: estimate exceeds about once in 700 (three standard errors of 1.04 / sqrt(registers)).
SKETCH_LG = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_LG / 2)


def distinct_sketches(tx: DataFrame, type_col: str = S.TYPE, step: str = S.STEP, lg: int = SKETCH_LG) -> DataFrame:
    """(type, step, origins, destinations): a HyperLogLog sketch of each column per
    cell, of a few KB whatever the rows.  Nulls are not counted."""
    return tx.groupBy(F.col(type_col).alias("type"), F.col(step).cast("long").alias("step")).agg(
        F.hll_sketch_agg(S.ORIG, lg).alias("origins"), F.hll_sketch_agg(S.DEST, lg).alias("destinations"))


def sketched_distinct(sketches: DataFrame, types: Iterable[str] | None = None, step_lo: int | None = None,
                      step_hi: int | None = None) -> DataFrame:
    """Estimated distinct origins and destinations of a slice: the sketches of its
    cells united.  Relative error as of ``SKETCH_ERROR``; :func:`profile.kpis` is the
    exact way and stays the default."""
    types = list(types or [])
    part = sketches.where(F.col("type").isin(types)) if types else sketches
    if step_lo is not None:
        part = part.where(F.col("step") >= step_lo)
    if step_hi is not None:
        part = part.where(F.col("step") <= step_hi)
    return part.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in ("origins", "destinations")])
