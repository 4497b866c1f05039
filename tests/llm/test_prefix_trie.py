import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from txrisk.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, g1 string"


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            md = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append(((turn is not None, turn or 0), md, role, text))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        anchor = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(anchor, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, who in members.items():
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
    return {(min(who), len(n), min(members[n[:-1]]) if n else None, len(who), children[n], leaves[n], saved[n],
             hashlib.sha256(",".join(str(c) for c in sorted(who) if whole[c] == n).encode()).hexdigest())
            for n, who in members.items()}


def made(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def invented(n, seed, span):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "no 😀", "", None]))
            for c in range(n) for t in range(rng.randrange(1, 8))]
    rows += [(span + i, t, "user", f"own {i} {t}") for i in range(30) for t in range(9)]
    rows += [(5000 + i, t, "user", "copy") for i in range(200) for t in range(3)]  # copies without an anchor
    rows += [(-250, 1, "user", "x"), (-200, 1, "user", "y"), (-200, 2, "user", "z"), (3, None, "user", "first"),
             (3, 0, "user", "tie b"), (3, 0, "user", "tie a"), (3, 0, "user", "tie a"), (None, 1, "user", "of no one"),
             (7001, 0, "user", "x" * 200_000)]
    return rows


@pytest.mark.parametrize("cells", [8, 0])
def test_equals_brute_force(spark, monkeypatch, cells):
    """Also with a sketch too small to prove much, where most rows are grouped."""
    if not cells:
        monkeypatch.setattr(prefix_trie, "MAX_BITS", 5)
        monkeypatch.setattr(prefix_trie, "MIN_BITS", 5)
        monkeypatch.setattr(prefix_trie, "SEGMENT", 16)
    rows = invented(300, 1, 1000)
    got = prefix_trie.prefix_trie(made(spark, rows)).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(rows)


def test_an_estimate_of_one_proves_a_singleton(spark):
    rows = invented(200, 2, 1000)
    prefixes = prefix_trie.rebuilt_prefixes(made(spark, rows))
    screened = prefix_trie._screen(prefixes).collect()
    seen = defaultdict(set)
    for r in screened:
        seen[r.g1, r.g2].add(r.conv)
    assert all(len(seen[r.g1, r.g2]) == 1 for r in screened if not r.maybe)
    assert sum(not r.maybe for r in screened) > 0.8 * sum(len(seen[r.g1, r.g2]) == 1 for r in screened)


def test_one_turnless_conversation_and_none(spark):
    # crc32("4") % 6 > 0 and there is no conversation 0: nothing of it is left but the root
    assert zlib.crc32(b"4") % 6 > 0
    rows = [(4, 0, "user", "gone")]
    assert {tuple(r) for r in prefix_trie.prefix_trie(made(spark, rows)).collect()} == brute(rows)
    assert prefix_trie.prefix_trie(made(spark, rows).where("false")).collect() == []
    assert prefix_trie.prefix_trie(made(spark, [(None, 0, "user", "x")])).collect() == []
