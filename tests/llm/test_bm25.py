import math
import random
from collections import Counter

import pytest
from texts import invented, lower, words

from txrisk.llm import bm25


def brute(rows, k):
    tf = {i: Counter(words(lower(t))) for i, t in rows}
    n, df = len(rows), Counter(w for c in tf.values() for w in c)
    size = {i: sum(c.values()) for i, c in tf.items()}
    mean = sum(size.values()) / n
    out = {}
    for q in (i for i in tf if i % 100 == 0):
        scores = {i: sum(m * math.log(1 + (n - df[w] + .5) / (df[w] + .5)) * c[w] * 2.2
                         / (c[w] + 1.2 * (.25 + .75 * size[i] / mean)) for w, m in tf[q].items() if w in c)
                  for i, c in tf.items()}
        out[q] = sorted(((s, i) for i, s in scores.items() if s > 0), key=lambda x: (-x[0], x[1]))[:k]
    return {q: v for q, v in out.items() if v}


@pytest.mark.parametrize("shard, per_block, first", [(10_000, 2_000_000, 8), (70, 300, 8), (9, 2_000_000, 1), (20, 400, 2)])
def test_equals_brute_force(spark, monkeypatch, shard, per_block, first):
    monkeypatch.setattr(bm25, "SHARD_DOCS", shard)
    monkeypatch.setattr(bm25, "FIRST_SHARDS", first)  # several rounds of shards
    monkeypatch.setattr(bm25, "QUERY_TERMS", per_block)  # several blocks of queries
    rng = random.Random(3)
    rows = [(i, invented(rng, rng.choice([0, 3, 30, 200]), 60)) for i in range(0, 2000, 5)]
    rows += [(i + 1, t) for i, t in rows[:40]]  # ties
    got: dict = {}
    for r in sorted(bm25.bm25_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()):
        got.setdefault(r.query_id, []).append((r.score, r.doc_id))
    want = brute(rows, bm25.K)
    assert got.keys() == want.keys()
    for q in want:
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in want[q]])
        # equal scores may differ in the last bit, so ids are compared as sets of a score
        by = lambda hits: {round(s, 6): {i for t, i in hits if abs(t - s) < 1e-6} for s, _ in hits[:-1]}
        last = round(want[q][-1][0], 6)
        assert {s: i for s, i in by(got[q]).items() if s > last} == {s: i for s, i in by(want[q]).items() if s > last}


def test_shards_are_pruned_by_the_threshold():
    import numpy as np
    import pyarrow as pa
    rng = random.Random(1)
    texts = ["common " + invented(rng, 20, 5000) for _ in range(1500)] + ["rare rare rare rare common"] * 12
    counts = list(bm25.term_counts(pa.array(texts)))
    batch = bm25._shard(pa.array(range(len(texts))), counts)
    shard = bm25.Shard(batch.to_pylist()[0], 21.0)
    hash_of = lambda w: next(bm25.term_counts(pa.array([w])))[0][0]
    terms = np.sort(np.array([hash_of("rare"), hash_of("common")], np.uint64))
    weights = np.where(terms == hash_of("rare"), 8.0, 0.1)
    def scored(least):
        scores, looked = shard.scored([(terms, weights)], np.array([least]))
        return scores[0], looked[0]

    all_, looked = scored(0.0)
    some, less = scored(5.0)
    assert looked == 1512 and less == 12  # the common word is looked up where the rare one is
    assert np.allclose(np.where(all_ >= 5.0, all_, 0), some) and (some > 0).sum() == 12
    assert scored(1000.0)[1] == 0 and not scored(1000.0)[0].any()
    assert len(bm25._best(all_, 10)) == 12  # the ties at the k-th score


def test_thresholds_lose_nothing():
    """Random shards and thresholds: what reaches one is found with its whole score."""
    import numpy as np
    import pyarrow as pa
    rng = random.Random(2)
    for size in (1, 63, 64, 300):
        counts = list(bm25.term_counts(pa.array([invented(rng, rng.choice([0, 1, 5, 80]), 30) for _ in range(size)])))
        shard = bm25.Shard(bm25._shard(pa.array(range(size)), counts).to_pylist()[0], 40.0)
        queries = []
        for _ in range(20):
            terms, tf = counts[rng.randrange(size)]
            queries.append((terms, tf * np.array([rng.choice([0.01, 0.5, 5.0]) for _ in tf])))
        every = shard.scored(queries, np.zeros(20))[0]
        for least in (np.median(every, 1), every.max(1), every.max(1) * 2, every.max(1) * np.arange(20) / 20):
            got = shard.scored(queries, least)[0]
            assert np.allclose(got, np.where(every >= bm25._floor(least)[:, None], every, 0), rtol=1e-12, atol=0)


def test_string_ids_and_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(bm25, "SHARD_POSTINGS", 500)
    rng = random.Random(4)
    rows = [(f"id-{i}", invented(rng, rng.choice([5, 50]), 90)) for i in range(200)]
    rows += [("long", " ".join(f"v{i}" for i in range(30_000)) + " w1a w2b"), (None, rows[0][1]), ("none", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").coalesce(1)
    index = bm25.build_index(docs)
    assert index.count() > 3 and index.agg({"n": "sum"}).first()[0] == len(rows)
    got = bm25.search(index, docs.where("doc_id in ('id-0', 'id-7', 'long', 'none') or doc_id is null"))
    assert dict(got.dtypes)["query_id"] == dict(got.dtypes)["doc_id"] == "string"
    best = {r.query_id: r.doc_id for r in got.where("rank = 1").collect()}
    assert best == {"id-0": "id-0", "id-7": "id-7", "long": "long"}
    assert [r.doc_id for r in got.where("query_id = 'id-0' and rank < 3").orderBy("rank").collect()] == ["id-0", None]
