import random
import zlib

import numpy as np
import pytest
from texts import invented

from txrisk.llm import packing


JSON = packing.default_tokenizer().replace(".tiktoken", ".json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("path", [packing.default_tokenizer(), JSON])
def test_ids_equal_the_tokenizer(tokenizer, path):
    rng = random.Random(1)
    bits = ["a", "the", "Öl", "漢字", "😀", " ", "  ", "\n", "\n\n", "\t", " \n", "'s", "123", "...", " ", " ", "<|endoftext|>", "\r"]
    texts = ["", " ", *["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(3000)],
             *[invented(rng, 300, 50) for _ in range(20)]]
    ids = packing.Ids(path)
    for at in range(0, len(texts), 100):
        some = texts[at:at + 100]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        assert [x.tolist() for x in ids.of(some)] == want


@pytest.mark.parametrize("path", [packing.default_tokenizer(), JSON])
def test_special_strings_have_their_ids(spark, path):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(JSON)  # as it is, no flag set
    rng = random.Random(2)
    bits = ["a", " the", "Öl", " ", "  ", "\n", "<|endoftext|>", "<|endoftext|", "|>", " <|endoftext|> ", "<|"]
    texts = ["a <|endoftext|> b", *["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(300)]]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    assert [x.tolist() for x in packing.Ids(path, packing.special_strings(path)).of(texts)] == want
    got = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    assert {r.doc_id: (r.length, r.ids_crc32) for r in got} == {
        i: (len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes())) for i, ids in enumerate(want)}


def test_cut_points():
    assert packing.cut_points(5, 4) == [(0, 1), (1, 5)]
    assert packing.cut_points(8, 4) == [(0, 4), (4, 8)]
    assert packing.cut_points(4, 4) == [(0, 4)] and packing.cut_points(1, 4) == [(0, 1)]


def best_fit(lengths, size):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(size - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_supersteps_pack_as_best_fit_does(seed):
    rng = random.Random(seed)
    size = rng.choice([7, 32, 100])
    lengths = [min(size, int(rng.expovariate(1 / rng.choice([3, 20]))) + 1) for _ in range(rng.randrange(1, 600))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.supersteps(counts, size)
    at: dict = {}
    placed: dict = {}
    for length, lo, hi, first, each, offset in plan:
        for r in range(lo, hi):
            at.setdefault(first + (r - lo) // each, []).append((offset + (r - lo) % each * length, length))
            placed[length, r] = placed.get((length, r), 0) + 1
    assert placed == {(n, r): 1 for n, c in counts.items() for r in range(c)}
    for held in at.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= size
    assert len(at) <= best_fit(lengths, size) + max(1, len(lengths) // 200)


@pytest.mark.parametrize("seed", range(4))
def test_plan_has_the_rows_that_are_stated(seed):
    rng = random.Random(seed)
    counts = {n: rng.randrange(1, 10 ** rng.randrange(1, 8)) for n in rng.sample(range(1, 1025), rng.choice([30, 400, 1024]))}
    assert len(packing.supersteps(counts, 1024)) <= 32 * len(counts)


def test_packed_documents(spark, tokenizer):
    rng = random.Random(3)
    rows = [(i, invented(rng, rng.choice([0, 1, 7, 60, 400, 1500]))) for i in range(80)] + [(80, None)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = {}
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for p, (s, e) in enumerate(packing.cut_points(len(ids), 1024)):
            want[i, p] = (s, e - s, zlib.crc32(ids[s:e].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    by: dict = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
        assert sum(n for _, n in held) <= 1024
    assert len(by) <= best_fit([w[1] for w in want.values()], 1024) + 1
