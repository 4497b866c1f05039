from conftest import tx_frame, tx_row
from txrisk import schema as S
from txrisk.operators.balances import mismatch_by_label, mismatch_long, reconcile


def test_cent_gaps(spark):
    # origin gaps 0.00, 0.01, 0.02; destination exact
    rows = [tx_row(1, 1, amount="10.00", old_orig="100.00", new_orig="90.00"),
            tx_row(2, 1, amount="10.00", old_orig="100.01", new_orig="90.00"),
            tx_row(3, 1, amount="10.00", old_orig="100.02", new_orig="90.00"),
            tx_row(4, 1, amount="10.00", old_orig=None, new_orig="90.00")]
    out = reconcile(tx_frame(spark, rows)).orderBy(S.TX_ID).collect()
    assert [r[S.ORIG_MISMATCH] for r in out] == [0, 0, 1, None]
    assert [str(r[S.ORIG_DIFF]) if r[S.ORIG_DIFF] is not None else None for r in out] == \
        ["0.00", "0.01", "0.02", None]
    assert [r[S.DEST_MISMATCH] for r in out] == [0, 0, 0, 0]


def test_negative_gap_is_mismatch(spark):
    rows = [tx_row(1, 1, amount="10.00", old_dest="5.00", new_dest="14.97")]
    r = reconcile(tx_frame(spark, rows)).first()
    assert str(r[S.DEST_DIFF]) == "-0.03" and r[S.DEST_MISMATCH] == 1


def test_mismatch_summary_and_long(spark):
    rows = [tx_row(1, 1, fraud=1, old_orig="100.05", new_orig="90.00"),
            tx_row(2, 1, fraud=1),
            tx_row(3, 1, fraud=0)]
    enr = reconcile(tx_frame(spark, rows))
    m = {r[S.LABEL]: r for r in mismatch_by_label(enr).collect()}
    assert m[1]["orig_mismatch_pct"] == 50.0 and m[0]["orig_mismatch_pct"] == 0.0
    long = mismatch_long(mismatch_by_label(enr)).collect()
    assert len(long) == 4 and {r["side"] for r in long} == {"origin", "destination"}
