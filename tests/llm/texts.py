"""Texts for the tests of this folder."""

import random
import re

import pytest


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def invented(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{'abcde'[rng.randrange(5)]}" for _ in range(n))


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality int, `key` string, size string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows,
    extra columns with names that operators use themselves."""
    rng = random.Random(7)
    long = "\n".join(invented(rng, 40) for _ in range(400))
    plain = invented(rng, 60)
    texts = [(1, plain, "a"), (1, plain, "a"), (2, plain, "b"), (3, None, "a"), (4, "", None), (None, plain, "a"),
             (None, None, None), (5, "  \n\t\n ", "a"), (6, "one", "b"), (7, long, "c"),
             (8, long.replace("w1a", "w2b", 1), "c"), (9, "ö 漢字 😀 " * 8, "d"), (10, invented(rng, 1300), "a"),
             (100, plain + " end", "a"), (200, "\n".join([plain[:80]] * 3), None), (300, "x" * 5000, "b")]
    return spark.createDataFrame([(i, t, None, s, None, 1, "k", "s") for i, t, s in texts], DOC_SCHEMA)
