import random

from texts import invented, words

from txrisk.llm import mixing


def fill(sizes, share=1.5, most=2):
    """Weights by name, null last; what is over a cap goes to the others until none is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w >= most * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / w for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    return target


def corpus(spark, rng):
    rows = []
    for i in range(300):
        source = rng.choice(["a", "a", "a", "b", "c", "d", None, "é"])
        rows.append((i, invented(rng, rng.choice([0, 1, 5, 40, 700])), source))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_taken(spark):
    rows, docs = corpus(spark, random.Random(3))
    size = {i: len(words(t)) for i, t, _ in rows}
    total: dict = {}
    for i, _, s in rows:
        total[s] = total.get(s, 0) + size[i]
    want = fill(total)
    got = mixing.mix_digest(docs).collect()
    taken: dict = {}
    by_id = {i: s for i, _, s in rows}
    assert sorted(r.doc_id for r in got) == list(range(300))
    for r in got:
        s = by_id[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], total[s])
        assert abs(r.target - want[s]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    assert all(taken[s] == int(want[s]) for s in total)
    assert sorted(got) == sorted(mixing.mix_digest(docs.repartition(5)).collect())


def test_mix_rows_follow_the_schedule(spark):
    rows, docs = corpus(spark, random.Random(4))
    mixed = mixing.mix(mixing.sized(docs), block_words=64)
    got = [r for r in mixed.collect() if r.slot is not None]
    assert all(0 <= r.from_word < r.to_word <= r.size for r in got)
    # every slot is of one source, and any stretch of slots has the sources by their targets
    source = {}
    for r in got:
        assert source.setdefault(r.slot, r.src) == r.src
    targets = {r.src: r.target for r in got}
    n = len(source)
    half = sorted(source)[:n // 2]
    for src, target in targets.items():
        share = sum(source[k] == src for k in half) / len(half)
        assert abs(share - target / sum(targets.values())) < 0.05


def test_van_der_corput(spark):
    got = [r[0] for r in spark.range(8).select(mixing.van_der_corput(mixing.F.col("id"))).collect()]
    assert got == [0.0, 0.5, 0.25, 0.75, 0.125, 0.625, 0.375, 0.875]


def test_documents_come_as_often_as_taken(spark):
    _, docs = corpus(spark, random.Random(5))
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix_digest(docs).collect()}
    count: dict = {}
    for r in mixing.mixed_documents(docs).collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == {i: int(t / s + 0.5) for i, (t, s) in taken.items() if s and int(t / s + 0.5)}
