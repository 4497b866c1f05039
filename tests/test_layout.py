"""Bucketed velocity layout and clustered table."""

import glob
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01, plan_text, tx_frame, tx_row
from txrisk import schema as S
from txrisk.operators import layout as L
from txrisk.operators.velocity import with_velocity
from txrisk.sources.events import load_transactions


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(map(str, r)) for r in df.select(*cols).collect()))


def _final(df):
    df.collect()
    return plan_text(df).split("== Initial Plan ==")[0]


def test_velocity_of_the_layout_has_no_exchange(spark):
    risky = load_transactions(spark, SF01, types=S.RISKY_TYPES)
    layout = L.write_velocity_layout(risky, tempfile.mkdtemp(prefix="txrisk-layout-"), buckets=6)
    try:
        out = L.velocity_of_layout(spark, layout)
        assert _rows(out) == _rows(with_velocity(risky))
        plan = _final(out)
        assert "SortMergeJoin" in plan and "Window" in plan and "Exchange" not in plan
        assert plan.count("Scan parquet") // 2 <= 2  # rows once, totals once
    finally:
        layout.drop(spark)


def test_layout_opens_in_another_session(spark):
    risky = load_transactions(spark, SF001, types=S.RISKY_TYPES)
    layout = L.write_velocity_layout(risky, tempfile.mkdtemp(prefix="txrisk-layout-"), buckets=4)
    other = spark.newSession()
    for t in (layout.rows, layout.totals):
        spark.sql(f"DROP TABLE {t}")  # the files stay: their folder was given
    out = L.velocity_of_layout(other, L.open_velocity_layout(other, layout))
    assert _rows(out) == _rows(with_velocity(risky)) and "Exchange" not in _final(out)
    layout.drop(other)


def test_layout_edges(spark):
    rows = [tx_row(1, None), tx_row(2, None), tx_row(3, 1), tx_row(4, 25), tx_row(5, 26), tx_row(6, -3), tx_row(7, 3, dest=None),
            tx_row(8, 4, dest=None), tx_row(9, 4, dest="null"), tx_row(10, 4, amount=None), tx_row(11, None, dest=None)]
    df = tx_frame(spark, rows)
    layout = L.write_velocity_layout(df, tempfile.mkdtemp(prefix="txrisk-layout-"), buckets=3)
    assert _rows(L.velocity_of_layout(spark, layout)) == _rows(with_velocity(df))
    layout.drop(spark)
    with pytest.raises(ValueError):
        L.write_velocity_layout(df.withColumn(L.KEY, F.lit(1)), tempfile.mkdtemp(), buckets=3)


def test_a_hot_destination_is_split_over_buckets(spark):
    hot = spark.range(6000).select(
        F.col("id").alias(S.TX_ID), (F.col("id") % 700 + 1).cast("int").alias(S.STEP),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("M"), F.col("id") % 97)).alias(S.DEST),
        (F.col("id") % 1000).cast("decimal(18,2)").alias(S.AMOUNT))
    layout = L.write_velocity_layout(hot, tempfile.mkdtemp(prefix="txrisk-layout-"), buckets=8)
    sizes = [spark.read.parquet(f).where(F.col(S.DEST) == "HOT").count() for f in glob.glob(f"{layout.path}/rows/*.parquet")]
    assert sum(sizes) == 2000 and max(sizes) < 700
    assert _rows(L.velocity_of_layout(spark, layout)) == _rows(with_velocity(hot))
    layout.drop(spark)


@pytest.fixture(scope="module")
def clustered(spark):
    path = tempfile.mkdtemp(prefix="txrisk-clustered-") + "/t"
    tx = load_transactions(spark, SF01)
    L.write_clustered(tx, path, files=16)
    return tx, path


def test_clustered_round_trip(spark, clustered):
    tx, path = clustered
    back = L.read_clustered(spark, path)
    assert back.columns == tx.columns and _rows(back) == _rows(tx)


def _files_read(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles")
    return text.value()


def test_slices_read_a_fraction_of_the_files(spark, clustered):
    tx, path = clustered
    dest = tx.groupBy(S.DEST).count().orderBy(F.desc("count")).first()[0]
    every = len(glob.glob(f"{path}/cell=*/*.parquet"))
    cases = {"steps": dict(step_lo=100, step_hi=140), "account": dict(account=dest),
             "both": dict(account=dest, step_lo=100, step_hi=140)}
    share = {}
    for name, kw in cases.items():
        got = L.read_clustered(spark, path, **kw)
        want = tx
        if "account" in kw:
            want = want.where(F.col(S.DEST) == dest)
        if "step_lo" in kw:
            want = want.where(F.col(S.STEP).between(100, 140))
        assert _rows(got) == _rows(want)
        share[name] = len({r[0] for r in got.select(F.input_file_name()).distinct().collect()}) / every
        assert "PartitionFilters: [cell" in plan_text(got) or "cell#" in plan_text(got).split("PartitionFilters: [", 1)[1].split("]")[0]
    assert share["steps"] < 0.25 and share["account"] < 0.25 and share["both"] < 0.05
    assert L.read_clustered(spark, path, step_lo=10**6).count() == 0


def test_clustered_nulls_and_empty(spark):
    df = tx_frame(spark, [tx_row(1, None), tx_row(2, 5, dest=None), tx_row(3, 9)])
    for rows in (df, df.where("false")):
        path = tempfile.mkdtemp(prefix="txrisk-clustered-") + "/t"
        L.write_clustered(rows, path, files=2)
        assert L.read_clustered(spark, path).count() == rows.count() if rows.count() else True


def test_interleaving_is_a_bijection(spark):
    got = spark.range(256).select(L.interleaved(F.shiftright("id", 4), F.col("id").bitwiseAND(F.lit(15)), 4).alias("z"), "id").collect()
    assert len({r.z for r in got}) == 256
    assert all(L._split_bits(r.z, 4) == (r.id >> 4, r.id & 15) for r in got)
