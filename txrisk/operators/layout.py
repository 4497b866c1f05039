"""Layouts on disk that later reads profit from: co-partitioned velocity tables
(W1-W3) and a clustered table that prunes files by time and account (K1, S2)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk import schema as S

# ------------------------------------------------------------ velocity layout

#: Helper columns of the velocity layout (never null, so that joins on them are
#: plain equi-joins): the key, the order value, and the block of order values.
KEY, ORDER, BLOCK = "layout_key", "layout_order", "layout_block"
_NULL_ORDER = -(1 << 40)


@dataclass
class VelocityLayout:
    """Two tables bucketed and sorted alike, and what it takes to open them again."""

    rows: str
    totals: str
    path: str
    key: str
    order: str
    lookback: int
    buckets: int

    def drop(self, spark: SparkSession) -> None:
        for t in (self.rows, self.totals):
            spark.sql(f"DROP TABLE IF EXISTS `{t}`")
        target = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _with_layout_keys(df: DataFrame, key: str, order: str, lookback: int) -> DataFrame:
    at = F.coalesce(F.col(order).cast("long"), F.lit(_NULL_ORDER))
    return (df.withColumn(KEY, F.when(F.col(key).isNull(), F.lit("null")).otherwise(F.concat(F.lit("is "), F.col(key).cast("string"))))
            .withColumn(ORDER, at).withColumn(BLOCK, F.floor(at / F.lit(lookback + 1)).cast("long")))


def write_velocity_layout(df: DataFrame, path: str, buckets: int, key: str = S.DEST, order: str = S.STEP,
                          value: str = S.AMOUNT, lookback: int = S.LOOKBACK_STEPS) -> VelocityLayout:
    """Write ``df`` so that velocity needs no further shuffle.

    A block is ``lookback + 1`` order values, so the frame of a row lies in its own
    block and the one before.  Rows go to buckets by (key, block), sorted by
    (key, block, order); their totals per (key, order) go to the same buckets, once
    for their own block and once for the next, which may look back on them.  A key
    that holds a third of all rows is thereby split by block, not read by one task.
    ``buckets`` should give files of about 100 to 500 MB."""
    spark = df.sparkSession
    clash = {c.lower() for c in df.columns} & {KEY, ORDER, BLOCK}
    if clash:
        raise ValueError(f"columns named like the layout's own: {sorted(clash)}")
    layout = VelocityLayout(f"velocity_rows_{uuid.uuid4().hex}", f"velocity_totals_{uuid.uuid4().hex}",
                            path.rstrip("/"), key, order, lookback, buckets)
    keys = [KEY, BLOCK, ORDER]

    def save(frame: DataFrame, table: str, folder: str) -> None:
        (frame.repartition(buckets, KEY, BLOCK).write.bucketBy(buckets, KEY, BLOCK).sortBy(*keys)
         .option("path", f"{layout.path}/{folder}").mode("overwrite").saveAsTable(table))

    save(_with_layout_keys(df, key, order, lookback), layout.rows, "rows")
    own = (spark.table(layout.rows).groupBy(*keys)  # by the buckets: no shuffle before the halo
           .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")))
    save(own.unionByName(own.withColumn(BLOCK, F.col(BLOCK) + 1)), layout.totals, "totals")
    return layout


def open_velocity_layout(spark: SparkSession, layout: VelocityLayout) -> VelocityLayout:
    """Register the files of a layout in another session."""
    for table, folder in ((layout.rows, "rows"), (layout.totals, "totals")):
        columns = ", ".join(f"`{n}` {t}" for n, t in spark.read.parquet(f"{layout.path}/{folder}").dtypes)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{table}` ({columns}) USING parquet CLUSTERED BY ({KEY}, {BLOCK}) "
                  f"SORTED BY ({KEY}, {BLOCK}, {ORDER}) INTO {layout.buckets} BUCKETS LOCATION '{layout.path}/{folder}'")
    return layout


def velocity_of_layout(spark: SparkSession, layout: VelocityLayout, count_col: str = S.VELOCITY_COUNT,
                       sum_col: str = S.VELOCITY_AMOUNT) -> DataFrame:
    """The rows of a layout with their velocity: the totals' window runs within the
    buckets and joins the rows bucket by bucket, without an exchange.  Same values
    as :func:`txrisk.operators.velocity.with_velocity` (a null order sees only its
    like: its block is its own)."""
    w = Window.partitionBy(KEY, BLOCK).orderBy(ORDER).rangeBetween(-layout.lookback, 0)
    rolled = spark.table(layout.totals).select(KEY, BLOCK, ORDER, F.struct(F.sum("n").over(w).alias("n"), F.sum("total").over(w).alias("total")).alias("v"))
    # one row per (key, block), with at most lookback + 1 order values of its own
    blocks = (rolled.where(F.floor(F.col(ORDER) / F.lit(layout.lookback + 1)) == F.col(BLOCK)).groupBy(KEY, BLOCK)
              .agg(F.map_from_entries(F.collect_list(F.struct(ORDER, "v"))).alias("layout_values")))
    rows = spark.table(layout.rows)
    names = [c for c in rows.columns if c not in (KEY, ORDER, BLOCK)]
    value = F.element_at("layout_values", F.col(ORDER))
    return rows.hint("merge").join(blocks, [KEY, BLOCK]).select(
        *names, value["n"].alias(count_col), value["total"].alias(sum_col))


# ---------------------------------------------------------- clustered table

CELL = "cell"
CELL_BITS = 4
_GRID = "_grid"


def _hash_part(account: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(account), 64 - bits).cast("int")


def _step_part(step: Column, lo: Column, hi: Column, bits: int) -> Column:
    """The place of a step in 2**bits equal parts of [lo, hi]; 0 for a null."""
    at = F.call_function("div", (step.cast("long") - lo) * (1 << bits), hi - lo + 1).cast("int")
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), at)), F.lit(0))


def interleaved(a: Column, b: Column, bits: int) -> Column:
    """Bits of two numbers of ``bits`` bits in turn, those of ``a`` first."""
    out = F.lit(0)
    for i in range(bits):
        bit = lambda x: F.shiftright(x, i).bitwiseAND(F.lit(1))  # noqa: E731, B023
        out = out.bitwiseOR(F.shiftleft(bit(a), 2 * i + 1)).bitwiseOR(F.shiftleft(bit(b), 2 * i))
    return out


def _split_bits(z: int, bits: int) -> tuple[int, int]:
    a = sum((z >> (2 * i + 1) & 1) << i for i in range(bits))
    return a, sum((z >> (2 * i) & 1) << i for i in range(bits))


def write_clustered(df: DataFrame, path: str, account: str = S.DEST, step: str = S.STEP, bits: int = CELL_BITS,
                    files: int | None = None) -> None:
    """Parquet clustered by time and account at once: a folder per value of the
    interleaved bits of a step's place in the range of steps and of the account's
    hash, ``bits`` of each.  A slice by steps, by account or by both reads the
    folders of its cells only.

    Rows are range-partitioned by (cell, hash of the row), so a cell of many rows,
    such as a hot account's, is spread over tasks, and a task writes few folders.
    The bounds of the steps are kept beside the table in ``_grid``."""
    if CELL in {c.lower() for c in df.columns}:
        raise ValueError(f"a column is named {CELL}")
    spark = df.sparkSession
    bounds = df.agg(F.coalesce(F.min(step), F.lit(0)).cast("long").alias("lo"), F.coalesce(F.max(step), F.lit(0)).cast("long").alias("hi"))
    lo, hi = bounds.first()
    cell = interleaved(_step_part(F.col(step), F.lit(lo), F.lit(hi), bits), _hash_part(F.col(account), bits), bits)
    spread = F.xxhash64(*df.columns)
    ranged = df.withColumn(CELL, cell)
    ranged = ranged.repartitionByRange(files, CELL, spread) if files else ranged.repartitionByRange(CELL, spread)
    ranged.write.mode("overwrite").partitionBy(CELL).parquet(path)
    grid = spark.createDataFrame([(lo, hi, bits, account, step)], "lo long, hi long, bits int, account string, step string")
    grid.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_GRID}")


def read_clustered(spark: SparkSession, path: str, account: str | None = None, step_lo: int | None = None,
                   step_hi: int | None = None) -> DataFrame:
    """A slice of a table of :func:`write_clustered`: an account, a closed range of
    steps, both, or neither.  Folders outside of it are never listed as input."""
    grid = spark.read.parquet(f"{path.rstrip('/')}/{_GRID}").first()
    bits, width = grid["bits"], grid["hi"] - grid["lo"] + 1
    rows = spark.read.option("basePath", path).parquet(path)
    place = lambda s: max(0, min((1 << bits) - 1, ((s - grid["lo"]) << bits) // width))
    first = 0 if step_lo is None else place(step_lo)
    last = (1 << bits) - 1 if step_hi is None else place(step_hi)
    want = None
    if account is not None:
        want = spark.range(1).select(_hash_part(F.lit(account), bits)).first()[0]
        rows = rows.where(F.col(grid["account"]) == account)
    cells = [z for z in range(1 << 2 * bits) for a, b in [_split_bits(z, bits)]
             if first <= a <= last and (want is None or b == want)]
    if len(cells) < 1 << 2 * bits:
        rows = rows.where(F.col(CELL).isin(cells))
    if step_lo is not None:
        rows = rows.where(F.col(grid["step"]) >= step_lo)
    if step_hi is not None:
        rows = rows.where(F.col(grid["step"]) <= step_hi)
    return rows.drop(CELL)
