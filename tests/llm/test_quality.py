import random
from collections import Counter

from texts import invented, words
from txrisk.llm import quality, textnum

import pyarrow as pa


def brute(text):
    ws = words(text)
    out = {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(c in "#*$%&|<>" for c in text or "")}
    seen, lines = set(), [x for x in (text or "").split("\n") if words(x)]
    out |= {"n_lines": len(lines), "line_chars": sum(map(len, lines)), "n_dup_lines": 0, "dup_line_chars": 0}
    for x in lines:
        if x in seen:
            out["n_dup_lines"] += 1
            out["dup_line_chars"] += len(x)
        seen.add(x)
    for n in quality.LENGTHS:
        grams = [tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)]
        count = Counter(grams)
        inside = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + n)}
        out[f"dup_chars_{n}"] = sum(len(ws[j]) for j in inside)
        if n == 5:
            out["n_repeat_words"] = len(inside)
    return out


def texts(rng):
    pool = ["", None, "\n", "a", "a\n", "\na\na\n", "x y z x y z x y z x y z", "ö 漢 ö 漢 ö 漢 ö 漢 ö 漢 ö", "&|<>#\t#\r\n#"]
    for _ in range(60):
        lines = [invented(rng, rng.randrange(1, 12), 3 if rng.random() < 0.4 else 300) for _ in range(rng.randrange(1, 9))]
        lines += [rng.choice(lines) for _ in range(rng.randrange(3))]
        pool.append(rng.choice(["\n", "\n\n", " \n"]).join(lines))
    return pool


def test_measures_equal_brute_force(monkeypatch):
    rng = random.Random(1)
    pool = texts(rng)
    for size in (1, 300, 1 << 22):  # texts alone, a few, or all in one block
        monkeypatch.setattr(textnum, "BLOCK_BYTES", size)
        got = quality._measures(pa.array(pool)).to_pylist()
        assert got == [{m: brute(t)[m] for m in quality.MEASURES} for t in pool]


def test_verdict(spark):
    rng = random.Random(2)
    clean = invented(rng, 200, 5000)
    docs = spark.createDataFrame([
        (1, clean), (2, "too few words"), (3, (invented(rng, 8, 5000) + " ") * 9),
        (4, "\n".join(["the same line"] * 8 + [invented(rng, 3, 5000) for _ in range(12)])),
        (5, clean + "\n" + clean[:40])], "doc_id long, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.quality_digest(docs).collect()}
    assert got == {1: (False, True), 2: (True, False), 3: (True, False), 4: (True, False), 5: (False, True)}
    assert sorted(r.doc_id for r in quality.keep_good(docs).collect()) == [1, 5]
