import random
from itertools import combinations

import pytest
from texts import invented, lower, words

from txrisk.llm import linking, ngram_join


def shingles(text):
    w = words(lower(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(rng):
    rows = []
    for _ in range(25):
        base = invented(rng, rng.choice([1, 3, 5, 6, 9, 30, 90, 200]), rng.choice([6, 400])).split(" ")
        for _ in range(rng.choice([1, 1, 2, 12])):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = invented(rng, 1)
            if rng.random() < 0.3:
                w += invented(rng, rng.randrange(1, 25)).split(" ")
            rows.append((len(rows), " ".join(w).upper() if rng.random() < 0.1 else " \n".join(w)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \t\n")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("pairs", [1, 0])  # 0: pivot rounds as for large groups
def test_components_equal_brute_force(spark, monkeypatch, pairs):
    monkeypatch.setattr(linking, "PAIRS_PER_MEMBER", pairs)
    rows = corpus(random.Random(12 + pairs))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.component_ids(docs).collect()}
    assert got == brute(rows)


def test_screen_keeps_every_linked_class(spark, monkeypatch):
    """Credits of linked classes reach what the join asks for, whatever a task holds."""
    monkeypatch.setattr(ngram_join, "HOLD", 50)
    rows = corpus(random.Random(5))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.component_ids(docs).collect()}
    assert got == brute(rows)


def test_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(2)
    base = invented(rng, 80).split(" ")
    rows = []
    for i in range(300):
        w = list(base)
        w[i % 80] = f"x{i}"
        rows.append((i, " ".join(w)))
    pairs = []
    real = linking.written

    def spy(df, name):
        out = real(df, name)
        if name == "pairs":
            pairs.append(out.count())
        return out
    monkeypatch.setattr(linking, "written", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.component_ids(docs).collect()
    assert {r.component_id for r in got} == {0}
    assert sum(pairs) < 300 * 60 < 300 * 299 / 2


def test_components_of_a_long_chain(spark):
    links = [(i * 7919 % 1009, (i + 1) * 7919 % 1009) for i in range(300)]
    got = linking.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == 301 and {r.root for r in got} == {min(min(x) for x in links)}


def test_keep_one(spark):
    rng = random.Random(9)
    a, b = invented(rng, 50), invented(rng, 50)
    docs = spark.createDataFrame([(5, a), (3, a), (3, a), (9, b), (8, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in ngram_join.keep_one(docs).collect()) == [3, 8, 9]


def test_blocks_of_a_group_make_the_pairs_that_need_comparing(spark, monkeypatch):
    import random
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rng = random.Random(6)
    tokens = {}
    for i in range(1000):
        family = i % 5  # values whose low bits, the mark, are their own
        tokens[i] = sorted(rng.sample([(v << 20) + v for v in range(family * 60, family * 60 + 44)], rng.randrange(28, 42)))
    rows = []
    for grp in range(6):
        ids = rng.sample(range(1000), [1, 2, 3, 9, 30, 60][grp])
        for i in ids:
            before = [rng.randrange(25) for _ in range(rng.randrange(3))] if rng.random() < 0.8 else None
            rows.append((grp, i, i % 7 if i % 3 else i, len(ids), len(tokens[i]) + i % 2, rng.randrange(1, 9), before))
    members = spark.createDataFrame(rows, "grp long, id long, comp long, size long, n long, pos long, before array<long>")
    lists = spark.createDataFrame(list(tokens.items()), "key long, tokens array<long>")
    got = sorted(map(tuple, ngram_join.rest_of(members, ngram_join.marks(lists)).collect()))
    want, linked = [], set()
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[1] < y[1] and x[2] != y[2] and not set(x[6] or []) & set(y[6] or []):
                n, m = sorted((x[4], y[4]))
                least = -(-(n + m) * 75 // 175)
                room = min(x[5], y[5]) + min(x[4] - x[5], y[4] - y[5])
                a, b = set(tokens[x[1]]), set(tokens[y[1]])
                if n * 100 >= m * 75 and room >= least:
                    linked |= {(x[1], y[1])} if len(a & b) >= least else set()
                    if len({v % 1024 for v in a} ^ {v % 1024 for v in b}) <= len(a) + len(b) - 2 * least:
                        want.append((x[1], y[1]))
    assert got == sorted(want) and len(want) > 10 and linked <= set(got)


def test_every_partition_gets_one_bucket(spark):
    from pyspark.sql import functions as F
    for buckets in (1, 8, 37):
        numbers = ngram_join.even_buckets(spark, buckets)
        dealt = spark.createDataFrame([(n,) for n in numbers], "id long").select(F.pmod(F.hash("id"), F.lit(buckets)))
        assert [r[0] for r in dealt.collect()] == list(range(buckets))


def test_overlaps_of_a_cell():
    import random

    import numpy as np
    rng = random.Random(8)
    base = [rng.randrange(-2**63, 2**63) for _ in range(300)]
    docs = [sorted(rng.sample(base, rng.randrange(1, 60)) if i % 2 else rng.sample(base[:70], rng.randrange(40, 70))) for i in range(60)]
    extra = np.array([rng.randrange(5) for _ in docs])
    n = np.array([len(d) for d in docs]) + extra
    pairs = [(i, j) for i in range(60) for j in range(i + 1, 60)]
    rng.shuffle(pairs)
    a, b = (np.array(c) for c in zip(*pairs))
    got = ngram_join._linked(n, [np.array(d, np.int64) for d in docs], a, b)
    want = [100 * (k := len(set(docs[i]) & set(docs[j]))) >= 75 * (n[i] + n[j] - k) for i, j in pairs]
    assert got.tolist() == want and 50 < sum(want) < len(want) / 2
    assert ngram_join._linked(n, [np.array(d, np.int64) for d in docs], a[:0], b[:0]).tolist() == []


def test_shingles_are_shuffled_once(spark):
    sets = spark.createDataFrame([(1, 3, [5, 6, 7]), (2, 3, [5, 6, 7]), (3, 2, [6, 9])], "key long, n long, grams array<long>")
    lists = ngram_join.ordered(sets)
    got = {r.key: (r.n, r.shared, r.prefix, r.tokens) for r in lists.collect()}
    assert got == {1: (3, 3, [5], [5, 6, 7]), 2: (3, 3, [5], [5, 6, 7])}
    plan = ngram_join.ordered(sets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(gram") == 1, plan
