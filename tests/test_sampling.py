import hashlib

from pyspark.sql import functions as F

from conftest import SF001
from txrisk import schema as S
from txrisk.operators import sampling as U
from txrisk.sources.events import load_transactions


def _brute(ids, n, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}{i}".encode()).hexdigest(), i))[:n]


def test_hash_sample_matches_brute_force(spark, monkeypatch):
    tx = load_transactions(spark, SF001)
    ids = [r[0] for r in tx.where(F.col(S.LABEL) == 0).select(S.TX_ID).collect()]
    for prefix in (1, 2, U.PREFIX_HEX):  # small prefixes force a cut inside a bucket
        monkeypatch.setattr(U, "PREFIX_HEX", prefix)
        for n in (1, 37, 500, len(ids), len(ids) + 10):
            got = sorted(r[0] for r in U.legit_sample(tx, n).select(S.TX_ID).collect())
            assert got == sorted(_brute(ids, n)), (prefix, n)


def test_stratified_keeps_all_positives(spark):
    tx = load_transactions(spark, SF001)
    pos = tx.where(F.col(S.LABEL) == 1).count()
    s = U.stratified_sample(tx, n_total=300)
    assert s.count() == 300
    assert s.where(F.col(S.LABEL) == 1).count() == pos
    ids = [r[0] for r in tx.where(F.col(S.LABEL) == 0).select(S.TX_ID).collect()]
    got = sorted(r[0] for r in s.where(F.col(S.LABEL) == 0).select(S.TX_ID).collect())
    assert got == sorted(_brute(ids, 300 - pos))


def test_bottom_k_equals_the_sample_in_one_scan(spark):
    from conftest import plan_text

    tx = load_transactions(spark, SF001)
    for n in (1, 7, 300, 10**6):
        got = U.bottom_k(tx.repartition(5), n)
        want = U.hash_sample(tx, n)
        assert sorted(got.drop(U.DIGEST).collect()) == sorted(want.collect())
    assert plan_text(U.bottom_k(tx, 7), "simple").count("FileScan parquet") == 1
    assert U.bottom_k(tx.where("false"), 5).collect() == []


def test_bottom_k_of_appended_rows_merges(spark):
    tx = load_transactions(spark, SF001)
    parts = [U.bottom_k(tx.where(F.col(S.TX_ID) % 3 == i), 50) for i in range(3)]
    merged = U.merge_bottom_k(50, U.merge_bottom_k(50, parts[0], parts[1]), parts[2])
    assert sorted(merged.drop(U.DIGEST).collect()) == sorted(U.hash_sample(tx, 50).collect())


def test_tasks_hold_few_rows_of_a_long_partition():
    import hashlib

    import pyarrow as pa
    rows = [hashlib.md5(str(i).encode()).hexdigest() for i in range(5000)]
    batches = [pa.RecordBatch.from_pydict({U.DIGEST: rows[i:i + 100]}) for i in range(0, 5000, 100)]
    got = [x for b in U._least(10)(iter(batches)) for x in b.column(0).to_pylist()]
    assert sorted(got) == sorted(rows)[:10]
