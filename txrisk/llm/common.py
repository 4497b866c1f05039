"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.session import ensure_checkpoint_dir

#: A word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that an explicit broadcast may hold at most; beyond it joins shuffle.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base_1``, ... : a name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    name, i = base, 0
    while name.lower() in taken:
        i += 1
        name = f"{base}_{i}"
    return name


def written(df: DataFrame, name: str, *parts: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back:
    one job computes it and a lost executor never recomputes it.  ``parts`` are
    columns by which files are kept apart."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*parts).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._txrisk_path = path  # for session.discard
    return out


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when it holds at most ``limit`` rows (which
    are counted here, so pass a written table of narrow rows); the same frame
    for a shuffled join otherwise."""
    if df.limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df


def running_start(df: DataFrame, part: list[str], order: list[Column], size: Column,
                  name: str, hash_bits: int, bucket_bits: int = 12) -> DataFrame:
    """Adds ``name``: the sum of ``size`` over the earlier rows of the same
    ``part`` (no nulls in these columns), rows in the order of ``order``, whose
    first entry is a hash of ``hash_bits`` bits.

    No task sees a whole part: rows are summed per (part, leading bits of the
    hash), the 2**bucket_bits totals of a part get a running sum, and rows are
    summed in order within their bucket only.
    """
    b, base = free_name(df, "_bucket"), free_name(df, "_base")
    keys = [*part, b]
    df = df.withColumn(b, F.shiftright(order[0], hash_bits - bucket_bits))
    before = Window.partitionBy(*part).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    totals = (df.groupBy(*keys).agg(F.sum(size).alias(base))
              .withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0))))
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn(name, F.coalesce(F.sum(size).over(inner), F.lit(0)))
            .join(totals, keys)
            .withColumn(name, (F.col(name) + F.col(base)).cast("long"))
            .drop(b, base))
