"""Balance reconciliation (F6) and the label summaries over enriched rows
(A11, A12, R1)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.numeric import flag, half_up_ratio


def reconcile(df: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Add the origin/destination balance gaps and mismatch flags.

    ``orig_balance_diff = round(old - new - amount, 2)`` at the origin and
    ``dest_balance_diff = round(new - old - amount, 2)`` at the destination;
    a mismatch is ``abs(diff) > tolerance``.  On exact decimals a 1-cent gap
    is not a mismatch and a 2-cent gap is; NULL inputs give NULL.  The
    tolerance is compared as written, with all its decimals."""
    most = F.lit(Decimal(str(tolerance)))
    orig = F.round(F.col(S.OLD_ORIG) - F.col(S.NEW_ORIG) - F.col(S.AMOUNT), 2)
    dest = F.round(F.col(S.NEW_DEST) - F.col(S.OLD_DEST) - F.col(S.AMOUNT), 2)
    return df.withColumns({
        S.ORIG_DIFF: orig,
        S.DEST_DIFF: dest,
    }).withColumns({
        S.ORIG_MISMATCH: flag(F.abs(F.col(S.ORIG_DIFF)) > most),
        S.DEST_MISMATCH: flag(F.abs(F.col(S.DEST_DIFF)) > most),
    })


def velocity_by_label(enriched: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Per label: rows, mean rolling count, mean rolling amount (2 dp)."""
    return enriched.groupBy(label).agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum(S.VELOCITY_COUNT).alias("_vc"),
        F.count(S.VELOCITY_COUNT).alias("_nc"),
        F.sum(S.VELOCITY_AMOUNT).alias("_va"),
        F.count(S.VELOCITY_AMOUNT).alias("_na"),
    ).select(
        label, "tx_count",
        half_up_ratio("_vc", "_nc", 2).alias("avg_dest_velocity_24h"),
        half_up_ratio("_va", "_na", 2, num_scale=2).alias("avg_dest_amount_24h"),
    )


def mismatch_by_label(enriched: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Per label: rows and the percentage (2 dp) of origin and destination
    mismatches among rows where the flag is known."""
    return enriched.groupBy(label).agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum(S.ORIG_MISMATCH).alias("_om"), F.count(S.ORIG_MISMATCH).alias("_on"),
        F.sum(S.DEST_MISMATCH).alias("_dm"), F.count(S.DEST_MISMATCH).alias("_dn"),
    ).select(
        label, "tx_count",
        half_up_ratio(F.col("_om") * 100, "_on", 2).alias("orig_mismatch_pct"),
        half_up_ratio(F.col("_dm") * 100, "_dn", 2).alias("dest_mismatch_pct"),
    )


def mismatch_long(mismatch: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Wide -> long: one row per (label, side) with the mismatch percentage."""
    return mismatch.select(
        label,
        F.col("orig_mismatch_pct").alias("origin"),
        F.col("dest_mismatch_pct").alias("destination"),
    ).unpivot([label], ["origin", "destination"], "side", "mismatch_pct")
