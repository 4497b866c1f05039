"""Exact-size, engine-independent samples.

A row's place in the sample order is ``md5(seed || tx_id)``: the sample of
size n is the n rows with the smallest digests.  This is uniform without
replacement, repeatable, and does not depend on partitioning.

Plan (no global sort, nothing on the driver): rows are counted per digest
prefix (``PREFIX_HEX`` hex digits, at most 16**PREFIX_HEX buckets); a
running total over that bounded bucket table gives the cut bucket where the
sample fills up.  Buckets below the cut are taken whole; inside the cut
bucket a row_number partitioned by bucket picks the remaining rows.  The
cut and the count before it come from one scalar subquery, so ``n`` may
itself be a column expression (a stratified sample sized from the data).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk import schema as S

PREFIX_HEX = 5
SAMPLE_SEED = 42


def sample_digest(seed: int = SAMPLE_SEED, key: str = S.TX_ID) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def hash_sample(df: DataFrame, n, seed: int = SAMPLE_SEED, key: str = S.TX_ID) -> DataFrame:
    """The ``n`` rows of ``df`` with the smallest ``md5(seed || key)``;
    all rows when ``df`` has fewer than ``n``.  ``n`` is an int or a
    scalar column."""
    n = F.lit(n).cast("long") if isinstance(n, int) else n.cast("long")
    h = df.withColumn("_h", sample_digest(seed, key)).withColumn(
        "_b", F.substring("_h", 1, PREFIX_HEX))
    buckets = h.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    # Running total over the bucket table: at most 16**PREFIX_HEX rows.
    running = buckets.withColumn(
        "_cum", F.sum("_c").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
    # one scalar subquery: the first bucket where the running total reaches
    # n, and the rows in all buckets before it
    at_cut = running.where(F.col("_cum") >= n).agg(
        F.min_by(F.struct(F.col("_b").alias("b"), (F.col("_cum") - F.col("_c")).alias("before")),
                 F.col("_b")).alias("s")).scalar()
    cut, before = at_cut.getField("b"), at_cut.getField("before")
    rn = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))
    keep = h.where(cut.isNull() | (F.col("_b") <= cut)).withColumn("_rn", rn)
    return (keep.where(cut.isNull() | (F.col("_b") < cut) | (F.col("_rn") <= n - before))
                .drop("_h", "_b", "_rn"))


def legit_sample(view: DataFrame, n: int = 50_000, seed: int = SAMPLE_SEED,
                 label: str = S.LABEL) -> DataFrame:
    """``min(n, negatives)`` negatives of a slice, uniformly at random."""
    return hash_sample(view.where(F.col(label) == 0), n, seed)


def stratified_sample(tx: DataFrame, n_total: int = 500_000, seed: int = SAMPLE_SEED,
                      label: str = S.LABEL) -> DataFrame:
    """All positives plus uniformly drawn negatives up to ``n_total`` rows
    (more than ``n_total`` only if the positives alone exceed it)."""
    pos = tx.where(F.col(label) == 1)
    n_neg = F.greatest(F.lit(n_total) - pos.agg(F.count(F.lit(1))).scalar(), F.lit(0))
    return pos.unionByName(hash_sample(tx.where(F.col(label) == 0), n_neg, seed))


# ------------------------------------------------------- mergeable least-k summary

DIGEST = "sample_digest"
#: Tasks that reduce the leasts of all scan tasks before the last one does.
MERGE_TASKS = 32


def _least(n: int):
    """The ``n`` rows of a partition with the least digests, at most 4 n held."""
    def cut(rows: pa.Table) -> pa.Table:
        if rows.num_rows <= n:
            return rows
        return rows.take(pc.select_k_unstable(rows, n, [(DIGEST, "ascending")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if last is not None:  # beyond the n-th least so far
                batch = batch.filter(pc.less_equal(batch.column(DIGEST), last))
            held.append(batch)
            size += batch.num_rows
            if size > 4 * n:
                kept = cut(pa.Table.from_batches(held))
                held, size = kept.to_batches(), kept.num_rows
                last = pc.max(kept.column(DIGEST))
        if held:
            yield from cut(pa.Table.from_batches(held)).combine_chunks().to_batches(max_chunksize=50_000)
    return run


def bottom_k(df: DataFrame, n: int, seed: int = SAMPLE_SEED, key: str = S.TX_ID) -> DataFrame:
    """The ``n`` rows with the least ``md5(seed || key)`` and that digest, in one scan:
    every task keeps its own ``n`` least, a few tasks those of all, one the last.  Its
    rows stand for all rows of ``df`` in :func:`merge_bottom_k`.  ``key`` must be
    unique and not null."""
    return _reduced(df.withColumn(DIGEST, sample_digest(seed, key)), n)


def _reduced(rows: DataFrame, n: int) -> DataFrame:
    schema = rows.schema
    own = rows.mapInArrow(_least(n), schema)
    some = own.repartition(MERGE_TASKS, DIGEST).mapInArrow(_least(n), schema)
    return some.coalesce(1).mapInArrow(_least(n), schema)  # MERGE_TASKS * n rows at most


def merge_bottom_k(n: int, *summaries: DataFrame) -> DataFrame:
    """The summary of all rows behind ``summaries`` (of the same seed and key, each of
    ``n`` rows at least or of all its rows)."""
    rows = summaries[0]
    for s in summaries[1:]:
        rows = rows.unionByName(s)
    return _reduced(rows, n)
