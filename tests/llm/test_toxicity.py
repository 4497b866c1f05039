import random
import zlib

import pytest
from texts import invented

from txrisk.llm import toxicity


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        toxic = int(rng.random() < 0.25)
        w = invented(rng, rng.randrange(8, 120), 3000).split(" ")
        if toxic:
            for _ in range(rng.randrange(1, 5)):
                w.insert(rng.randrange(len(w)), rng.choice(["moron", "scumbag", "zzlu" + rng.choice("abcdef"), "zzlu" + rng.choice("ghijk")]))
        docs.append((i, " ".join(w), "en", "src1"))
        if i % 3:
            labels.append((i, 1, toxic))
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    label = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    toxic = {i: any(x in t for x in ("moron", "scumbag", "zzlu")) for i, t, *_ in docs}
    return toxic, d, label, {r.doc_id: r for r in toxicity.toxicity(d, label).collect()}


def test_held_out_accuracy(scored):
    toxic, _, _, got = scored
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert sum(got[i].predicted == toxic[i] for i in held) / len(held) > 0.95


def test_held_out_labels_are_not_read(spark, scored):
    _, docs, labels, got = scored
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic"))
                                .otherwise(toxicity.F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, flipped).collect()}
    assert again == pytest.approx({i: r.score for i, r in got.items()})


def test_grammar():
    g = toxicity.Grammar({"idio": 5.0, "scum ": 4.0})
    plain = g.score("what an idiot")
    assert plain == 5.0 and g.score("scumbag") == 0.0 and g.score("Scum.") == 4.0
    assert g.score("not an idiot") < plain < g.score("you are an idiot")
    assert g.score("she said idiot") < plain
    assert g.score("not so good today. an idiot") == plain  # a negation ends with its clause
    assert g.score("kill") == 0 and g.score("I kill you") == toxicity.THREAT
    assert g.score("") == 0


def test_all_stems_that_pass_are_kept(spark):
    common = " ".join(f"c{i}x" for i in range(100))  # in all documents, more than any first cut by frequency would hold
    rare = [f"{chr(97 + i)}{chr(97 + j)}q" for i in range(26) for j in range(26) for _ in "1"]
    rows = [(f"{common} {' '.join(rare) + ' ' + ' '.join(r[::-1] for r in rare) if i < 20 else ''}", 1) for i in range(60)]
    rows += [(f"{common} {'aaq' if i < 150 else ''}", 0) for i in range(200)]
    got = toxicity.learn_stems(spark.createDataFrame(rows, "text string, toxic int"))
    assert {s.strip() for s in got} == {*rare, *(r[::-1] for r in rare)} - {"aaq"} and len(got) > 1300


# A plain reading of the same grammar: words of a clause one after the other, with flags.

def plain_stems(train):
    import math
    n = [sum(t == k for _, t in train) for k in (0, 1)]
    seen = [{}, {}]
    for text, toxic in train:
        words = plain_words((text or "").lower())
        for s in {s for w in words for s in [w + " ", *(w[:k] for k in (4, 5, 6) if len(w) >= k)]}:
            seen[toxic][s] = seen[toxic].get(s, 0) + 1
    out = {}
    for s, m in seen[1].items():
        c = seen[0].get(s, 0)
        odds = math.log((m + .5) / (n[1] + 1)) - math.log((c + .5) / (n[0] + 1))
        if m >= max(3, math.ceil(.004 * n[1])) and odds - 1.64 * math.sqrt(1 / (m + .5) + 1 / (c + .5)) >= 2:
            out[s] = odds
    return out


def plain_words(text):
    out, word = [], ""
    for i, ch in enumerate(text + " "):
        if ch.isalnum() or (ch == "'" and word and i + 1 < len(text) and text[i + 1].isalnum()):
            word += ch
        else:
            out += [word] if word else []
            word = ""
    return out


def plain_score(text, weights):
    kinds = {w: k for k, ws in toxicity.LEXICON.items() for w in ws.split()}
    text = (text or "").lower()
    for stop in "!?;:\n":
        text = text.replace(stop, ".")
    total = 0.0
    for clause in text.split("."):
        reach, reported, addressed, threatened = 0, False, False, False
        for w in plain_words(clause):
            weight = max([weights.get(w + " ", 0), *(weights.get(w[:k], 0) for k in (4, 5, 6) if len(w) >= k)])
            kind = "insult" if weight else kinds.get(w)
            damped = (toxicity.NEGATED if reach else 1) * (toxicity.REPORTED if reported else 1)
            total += weight * damped * (toxicity.ADDRESSED if addressed else 1)
            if threatened and kind == "target":
                total += toxicity.THREAT * damped
            reach = toxicity.REACH if kind == "negation" else max(reach - 1, 0)
            reported, addressed = reported or kind == "reported", addressed or kind == "target"
            threatened = kind == "threat" or (threatened and kind != "target")
    return total


def test_equals_a_plain_reading(spark):
    rng = random.Random(5)
    bits = ["moron", "morons", "Scumbag", "zq", "not", "never", "said", "you", "kill", "hurt", "dich", "töten", "isn't", "you're",
            ".", "!", ";", "\n", "the", "cat's", "x_y", "'", "é", "naïve", "fine", "12", "漢字"]
    docs = []
    for i in range(500):
        words = [rng.choice(bits[4:]) for _ in range(rng.randrange(40))]
        if i % 3 == 0:
            words.insert(rng.randrange(len(words) + 1), rng.choice(bits[:4]))
        docs.append((i, rng.choice([" ", ", "]).join(words) if i % 50 else rng.choice([None, "", "moron. " * 3000])))
    labels = [(i, int(i % 3 == 0)) for i, _ in docs if i % 2]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, raw int")
    got = {r.doc_id: r for r in toxicity.toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    toxic = dict(labels)
    train = [(t, toxic[i]) for i, t in docs if i in toxic and zlib.crc32(str(i).encode()) % 5]
    weights = plain_stems(train)
    assert weights == pytest.approx(toxicity.learn_stems(spark.createDataFrame(train, "text string, toxic int")))
    assert {"moro", "scumba"} <= weights.keys()
    import numpy as np
    raw = np.array([plain_score(t, weights) for t, _ in train])
    shift, slope = toxicity.fit_curve(raw, np.array([y for _, y in train]))
    for i, t in docs:
        want = 1 / (1 + np.exp(-(shift + slope * np.log1p(plain_score(t, weights)))))
        assert got[i].score == pytest.approx(want, abs=1e-9) and got[i].predicted == int(got[i].score >= .5)
