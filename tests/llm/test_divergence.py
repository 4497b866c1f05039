import random
import re
from collections import Counter, defaultdict

from texts import lower, odd_docs  # noqa: F401

from txrisk.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, top=divergence.TOP_TERMS):
    """(text, lang, source) rows -> the audit, with plain dictionaries."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = TERM.findall(lower(text))
        count[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (count[lang, s][t] + 1) // (total[s] + len(kept)) for t in kept} for s in sources}
        whole = {t: 1 + 10**9 * (sum(count[lang, s][t] for s in sources) + 1) // (sum(total.values()) + len(kept)) for t in kept}
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            term = [(t, (p[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if count[lang, s][t] and p[s][t] > whole[t]]
            for part, items, last in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:last]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)}
    return out


def made(spark, rows):
    return spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, term string")


def test_equals_brute_force(spark):
    rng = random.Random(3)
    stems = ["a", "Ab", "abcdefgh", "abcdefghi", "ABCDEFGHIJKLMNOP", "abcdefghijklmnopq", "é", "ö" * 9, "漢字" * 3, "x" * 33,
             "x" * 5000, "\u00a0", "zz", "z", *[f"t{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]]
    rows = [("".join(rng.choice(stems) + rng.choice([" ", "1", "\n", "_", "\x00"]) for _ in range(rng.randrange(60))),
             rng.choice(["en", "de", None]), rng.choice(["s", "t", "", None, "ü"])) for _ in range(150)]
    rows += [(None, "fr", "s"), ("", "fr", "t"), ("alone", "xx", None), rows[0], rows[0]]
    got = divergence.divergence(made(spark, rows)).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(rows)
    assert {r.value for r in got if r.lang == "fr"} == {0}


def test_tasks_that_hand_on_early_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(" ".join(f"q{chr(97 + rng.randrange(26))}{'y' * rng.randrange(30)}" for _ in range(200)), "en", f"s{i % 3}")
            for i in range(60)]
    monkeypatch.setattr(divergence, "TASK_TERMS", 10)
    assert {tuple(r) for r in divergence.divergence(made(spark, rows)).collect()} == brute(rows)


def test_only_the_first_terms_of_a_group(spark):
    rows = [(" ".join("b" * (1 + i) for i in range(40)), "en", "s")] * 3 + [("other " * 50, "en", "t")] * 3
    got = divergence.divergence(made(spark, rows), top=5).collect()
    assert {tuple(r) for r in got} == brute(rows, 5) and max(r.rank for r in got if r.part == "term") == 5


def test_counts_beyond_a_long_stay_exact():
    import numpy as np
    n, total = np.array([0, 5, 10**13]), np.array([3 * 10**13, 7, 3 * 10**13])
    assert divergence._shares(n, total).tolist() == [1 + 10**9 * (int(a) + 1) // int(t) for a, t in zip(n, total)]


def test_edges(odd_docs):
    rows = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    assert {tuple(r) for r in divergence.divergence(odd_docs).collect()} == brute(rows)
    assert divergence.divergence(odd_docs.where("false")).collect() == []
