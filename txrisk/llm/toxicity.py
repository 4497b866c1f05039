"""Toxicity (operator 9).

A weighted finite-state grammar reads a text clause by clause.  Four small
transducers run side by side (their product is the grammar): negation damps an
insult in the next few words, reported speech damps the rest of its clause, a
person addressed sharpens it, and a threat counts when it meets one.  A clause
scores the sum of its matches' weights, a document the sum over its clauses; a
logistic curve turns that into the score.

Insults are word stems with their log odds, learned from labelled documents.
Only labels of rows whose crc32(doc_id) mod 5 is not 0 are read, and of these
the ``TRAIN_ROWS`` with the least hash of the id at most.  Language, source and
id are no inputs of a score.

Defined results: null and empty texts have no match and get the least score; a
document labelled twice learns twice; unlabelled tables give the score 0 to
all; repeated rows get equal rows; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import written

TRAIN_ROWS = 20_000
#: Lengths of word beginnings that may be stems, besides whole words.
BEGINNINGS = (4, 5, 6)
#: Least documents and share of the toxic documents that a stem is found in, and least log odds (at the lower
#: end of their 90 % interval, so that chance findings in few documents don't count).
LEAST_DOCS, LEAST_SHARE, LEAST_ODDS = 3, 0.004, 2.0
#: Weights of the grammar: words that a negation reaches, its factor, those of reported speech and address, a threat.
REACH, NEGATED, REPORTED, ADDRESSED, THREAT = 3, 0.4, 0.6, 1.3, 6.0

# Closed word classes of four languages.
LEXICON = {
    "negation": "not never isn't aren't wasn't nicht kein keine niemals jamais aucun nunca jamás",
    "reported": "said says wrote quote quoted called reportedly sagte schrieb angeblich dit écrit selon dijo dice escribió según",
    "target": "you your you're yourself du dich dir euch toi vous tú ti usted ustedes",
    "threat": "kill hurt destroy murder shoot töten umbringen erschießen tuer frapper détruire matar golpear destruir",
}
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)*")
_CLAUSE = re.compile(r"[.!?;:\n]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def stems(word: str) -> set[str]:
    """The whole word (marked by a blank) and its beginnings."""
    return {f"{word} ", *(word[:n] for n in BEGINNINGS if len(word) >= n)}


# ---- the grammar: each transducer maps (state, class) to (state, factor of a match)

def _negation(s: int, c: str) -> tuple[int, float]:
    return (REACH if c == "negation" else max(s - 1, 0)), (NEGATED if s else 1.0)


def _reported(s: int, c: str) -> tuple[int, float]:
    return (1 if c == "reported" else s), (REPORTED if s else 1.0)


def _addressed(s: int, c: str) -> tuple[int, float]:
    return (1 if c == "target" else s), (ADDRESSED if s else 1.0)


def _threat(s: int, c: str) -> tuple[int, float]:
    return (1 if c == "threat" else 0 if c == "target" else s), (THREAT if s and c == "target" else 0.0)


def compose() -> dict[tuple, dict[str, tuple]]:
    """The product of the transducers: state -> class -> (state, factor of an
    insult, weight of a threat completed)."""
    arcs: dict[tuple, dict[str, tuple]] = {}
    todo = [(0, 0, 0, 0)]
    while todo:
        state = todo.pop()
        if state in arcs:
            continue
        arcs[state] = {}
        for c in (*LEXICON, "insult", "other"):
            (n, x), (r, y), (a, z), (t, threat) = (f(s, c) for f, s in zip(
                (_negation, _reported, _addressed, _threat), state, strict=True))
            arcs[state][c] = ((n, r, a, t), x * y * z, threat * x * y)
            todo.append((n, r, a, t))
    return arcs


class Grammar:
    def __init__(self, weights: dict[str, float]):
        import ahocorasick
        self.weights, self.arcs = weights, compose()
        self.classes = {w: c for c, ws in LEXICON.items() for w in ws.split()}
        self.finder = ahocorasick.Automaton()  # passes over texts without an insult or a threat at once
        for stem in [*weights, *LEXICON["threat"].split()]:
            self.finder.add_word(f" {stem.strip()}", 1)
        self.finder.make_automaton()

    def insult(self, word: str) -> float:
        return max((self.weights.get(s, 0.0) for s in stems(word)), default=0.0)

    def clause(self, words: list[str]) -> float:
        state, total = (0, 0, 0, 0), 0.0
        for w in words:
            weight = self.insult(w)
            c = "insult" if weight else self.classes.get(w, "other")
            state, factor, threat = self.arcs[state][c]
            total += weight * factor + threat
        return total

    def score(self, text: str) -> float:
        text = text.lower()
        if next(self.finder.iter(" " + re.sub(r"[\W_]", " ", text)), None) is None:
            return 0.0
        return sum(self.clause(_WORD.findall(c)) for c in _CLAUSE.split(text))


def scored(docs: DataFrame, weights: dict[str, float], cols: list[str]) -> DataFrame:
    """``cols`` of ``docs`` and raw, the sum of its clauses."""
    fields = ", ".join(f"{c} {dict(docs.dtypes)[c]}" for c in cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(weights)
        for batch in batches:
            raw = [grammar.score(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in cols], pa.array(raw, pa.float64())],
                                             names=[*cols, "raw"])
    return docs.select(*cols, "text").mapInArrow(run, f"{fields}, raw double")


def learn_stems(train: DataFrame) -> dict[str, float]:
    """Log odds of the stems that toxic documents have far more often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter = Counter()
            for text in batch.column("text"):
                words = set(_WORD.findall((text.as_py() or "").lower()))
                count.update({s for w in words for s in stems(w)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["stem", "n"])

    n = {r[0]: r[1] for r in train.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}
    total = lambda toxic, name: (train.where(F.col("toxic") == toxic).mapInArrow(run, "stem string, n long")
                                 .groupBy("stem").agg(F.sum("n").alias(name)))
    least = max(LEAST_DOCS, math.ceil(LEAST_SHARE * n[1]))
    # every stem that enough toxic documents have; a stem that none has is of no use
    found = (total(1, "n").where(F.col("n") >= least).join(total(0, "clean"), "stem", "left")
             .select("stem", "n", F.coalesce("clean", F.lit(0)).alias("clean")))
    odds = F.log((F.col("n") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    spread = F.sqrt(1 / (F.col("n") + 0.5) + 1 / (F.col("clean") + 0.5))
    # all stems that pass; each is in LEAST_SHARE of at most TRAIN_ROWS documents
    best = found.withColumn("odds", odds).where(F.col("odds") - 1.64 * spread >= LEAST_ODDS).orderBy(F.desc("odds"), "stem")
    return {r["stem"]: r["odds"] for r in best.toLocalIterator()}


def fit_curve(raw: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve through (raw, toxic), lightly held to small slopes."""
    x = np.column_stack([np.ones(len(raw)), np.log1p(raw)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.1])
        w = w + np.clip(np.linalg.solve(h, x.T @ (toxic - p) - np.array([0, 0.1]) * w), -3, 3)
    return float(w[0]), float(w[1])


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """text, toxic of at most ``rows`` labelled documents that aren't held out."""
    some = (labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
            .select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
            .orderBy(F.xxhash64("_id"), "_id", "toxic").limit(rows))
    return written(docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_id"))
                   .select("text", "toxic"), "train")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    train = training_rows(docs, labels)
    weights = learn_stems(train)
    shift, slope = -30.0, 0.0
    if weights:
        known = scored(train, weights, ["toxic"]).toPandas()  # TRAIN_ROWS rows at most
        shift, slope = fit_curve(known["raw"].to_numpy(), known["toxic"].to_numpy())
    score = 1 / (1 + F.exp(-(F.lit(shift) + F.lit(slope) * F.log1p("raw"))))
    return scored(docs, weights, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"))
