"""Stored summaries: account state, cube, sketches."""

import random
import tempfile

from pyspark.sql import functions as F

from conftest import SF001, SF01, tx_frame, tx_row
from txrisk import schema as S
from txrisk.operators import accounts as A
from txrisk.operators import cube as Q
from txrisk.operators import filters as FL
from txrisk.operators import profile as P
from txrisk.sources.events import load_transactions


def _rows(df):
    return sorted((tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect()))


def test_state_of_days_merged_equals_features_of_all(spark):
    risky = load_transactions(spark, SF001, types=S.RISKY_TYPES)
    path = tempfile.mkdtemp(prefix="txrisk-state-")
    for day, part in enumerate((F.col(S.TX_ID) % 3 == 0, F.col(S.TX_ID) % 3 == 1, F.col(S.TX_ID) % 3 == 2)):
        state = A.update_state(path, A.account_state(risky.where(part)), day)
    assert state.schema["total_sent"].dataType.simpleString() == "decimal(28,2)"
    assert _rows(A.features_of_state(state)) == _rows(A.customer_features(risky))


def test_a_repeated_batch_counts_once(spark):
    risky = load_transactions(spark, SF001, types=S.RISKY_TYPES)
    path = tempfile.mkdtemp(prefix="txrisk-state-")
    first, second = (A.dest_frequency(risky.where(c)) for c in (F.col(S.TX_ID) % 2 == 0, F.col(S.TX_ID) % 2 == 1))
    A.update_state(path, first, 1, A.merge_dest_frequency)
    A.update_state(path, second, 2, A.merge_dest_frequency)
    again = A.update_state(path, second, 2, A.merge_dest_frequency)
    assert _rows(again) == _rows(A.dest_frequency(risky))


def test_state_edges(spark):
    a = tx_frame(spark, [tx_row(1, 1, orig="C1", amount="5.00"), tx_row(2, 1, orig=None), tx_row(3, 1, orig="C1", amount=None)])
    b = tx_frame(spark, [tx_row(4, 2, orig="C1", amount="9999999999999999.99"), tx_row(5, 2, orig=None, fraud=None)])
    merged = A.merge_states(A.account_state(a), A.account_state(b), A.account_state(a.where("false")))
    assert _rows(A.features_of_state(merged)) == _rows(A.customer_features(a.unionByName(b)))


def test_cube_equals_direct_slices(spark):
    tx = load_transactions(spark, SF01)
    cube = Q.slice_cube(tx).cache()
    rng = random.Random(1)
    for _ in range(6):
        lo, hi = sorted(rng.randrange(-50, 900) for _ in range(2))
        types = rng.sample(S.TX_TYPES, rng.randrange(3))
        for kw in (dict(step_lo=lo, step_hi=hi), dict(step_lo=lo), dict(step_hi=hi), {}):
            want = P.kpis(FL.slice_tx(tx, types=types, **kw)).drop("origins", "destinations").first()
            assert Q.cube_kpis(cube, types, **kw).first() == want, (types, kw)
        assert _rows(Q.cube_activity(cube, types)) == _rows(P.activity_by_step(FL.slice_tx(tx, types=types)))
    cube.unpersist()


def test_cube_ranges_beyond_the_table_and_nulls(spark):
    rows = [tx_row(1, 5), tx_row(2, 5, amount=None, fraud=1), tx_row(3, 9, type_="PAYMENT", fraud=None), tx_row(4, None),
            tx_row(5, 7, type_=None)]
    tx = tx_frame(spark, rows)
    cube = Q.slice_cube(tx)
    asked = spark.createDataFrame([("TRANSFER", 0, 4), ("TRANSFER", 0, 100), ("TRANSFER", 6, 100), ("TRANSFER", 9, 3), ("PAYMENT", 9, 9),
                                   ("DEBIT", 1, 9), ("TRANSFER", 50, 60)], "type string, step_lo int, step_hi int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in Q.cube_slices(cube, asked).collect()}
    assert got == {("TRANSFER", 0, 4): (0, 0, 0, 0), ("TRANSFER", 0, 100): (2, 1, 1, 2), ("TRANSFER", 6, 100): (0, 0, 0, 0),
                   ("TRANSFER", 9, 3): (0, 0, 0, 0), ("PAYMENT", 9, 9): (1, 1, 0, 0), ("DEBIT", 1, 9): (0, 0, 0, 0),
                   ("TRANSFER", 50, 60): (0, 0, 0, 0)}
    assert Q.cube_kpis(cube).first() == P.kpis(tx).drop("origins", "destinations").first()
    empty = Q.slice_cube(tx.where("false"))
    assert empty.collect() == [] and Q.cube_kpis(empty).first() == P.kpis(tx.where("false")).drop("origins", "destinations").first()


def test_sketches_stay_within_their_error(spark):
    tx = load_transactions(spark, SF01)
    sketches = Q.distinct_sketches(tx).cache()
    for kw in ({}, dict(step_lo=100, step_hi=400), dict(types=["PAYMENT"]), dict(types=["TRANSFER"], step_hi=50)):
        near = Q.sketched_distinct(sketches, **kw).first()
        exact = P.kpis(FL.slice_tx(tx, **kw)).first()
        for c in ("origins", "destinations"):
            assert abs(near[c] - exact[c]) <= max(1, Q.SKETCH_ERROR * exact[c])
    assert Q.sketched_distinct(sketches, step_lo=10**6).first() == (0, 0)
    sketches.unpersist()
