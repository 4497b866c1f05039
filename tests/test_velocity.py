from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01, tx_frame, tx_row
from txrisk import schema as S
from txrisk.operators.velocity import with_velocity
from txrisk.sources.events import load_transactions


def _vel(df, **kw):
    out = with_velocity(df, **kw).select(S.TX_ID, S.VELOCITY_COUNT, S.VELOCITY_AMOUNT)
    return {r[0]: (r[1], r[2]) for r in out.collect()}


def test_window_edge(spark):
    # distance 24 is inside the frame, 25 is outside
    df = tx_frame(spark, [tx_row(1, 1), tx_row(2, 25), tx_row(3, 26)])
    v = _vel(df)
    assert [v[i][0] for i in (1, 2, 3)] == [1, 2, 2]
    assert float(v[2][1]) == 20.0 and float(v[3][1]) == 20.0


def test_peers_in_same_step(spark):
    df = tx_frame(spark, [tx_row(1, 5, amount="1.00"), tx_row(2, 5, amount="2.00")])
    v = _vel(df)
    assert v[1][0] == 2 and v[2][0] == 2
    assert float(v[1][1]) == 3.0


def test_null_step_sees_only_nulls(spark):
    df = tx_frame(spark, [tx_row(1, None), tx_row(2, None), tx_row(3, 1)])
    v = _vel(df)
    assert v[1][0] == 2 and v[2][0] == 2 and v[3][0] == 1


def test_null_key_is_one_group(spark):
    df = tx_frame(spark, [tx_row(1, 3, dest=None), tx_row(2, 4, dest=None), tx_row(3, 4)])
    v = _vel(df)
    assert v[1][0] == 1 and v[2][0] == 2 and v[3][0] == 1


def test_keys_are_separate(spark):
    df = tx_frame(spark, [tx_row(1, 1, dest="A"), tx_row(2, 2, dest="B"), tx_row(3, 3, dest="A")])
    v = _vel(df)
    assert (v[1][0], v[2][0], v[3][0]) == (1, 1, 2)


def test_exclude_current(spark):
    df = tx_frame(spark, [tx_row(1, 1), tx_row(2, 1), tx_row(3, 10)])
    v = _vel(df, exclude_current=True)
    assert v[1] == (0, None) and v[2] == (0, None)
    assert v[3][0] == 2


def test_preaggregated_equals_row_window(spark):
    """Property: the pre-aggregate + join plan equals the direct range window
    row for row on the sf0.01 risky rows."""
    risky = load_transactions(spark, SF01, types=S.RISKY_TYPES)
    w = Window.partitionBy(S.DEST).orderBy(S.STEP).rangeBetween(-24, 0)
    direct = risky.select(S.TX_ID, F.count(F.lit(1)).over(w).alias("c"),
                          F.sum(S.AMOUNT).over(w).alias("s"))
    ours = with_velocity(risky).select(S.TX_ID, F.col(S.VELOCITY_COUNT).alias("c2"),
                                       F.col(S.VELOCITY_AMOUNT).alias("s2"))
    j = direct.join(ours, S.TX_ID, "full_outer")
    bad = j.where(~F.col("c").eqNullSafe(F.col("c2")) | ~F.col("s").eqNullSafe(F.col("s2")))
    assert bad.count() == 0
    assert j.count() == risky.count()


def test_columns_with_helper_names_are_kept(spark):
    df = tx_frame(spark, [tx_row(1, 1), tx_row(2, 25)])
    for c in ("_vk", "_vo", "_vk1", "_n", "_s"):
        df = df.withColumn(c, F.lit(c))
    out = with_velocity(df)
    assert out.columns[:len(df.columns)] == df.columns
    assert [(r["_vk"], r["_vo"], r["_n"], r["_s"]) for r in out.collect()] == [("_vk", "_vo", "_n", "_s")] * 2
