"""Quality rules: repetition coverage (operator 1).

Every text's words get a 64-bit hash, and rolling hashes of 5 to 10 words run
over them in numpy.  Measured are the characters inside n-grams that occur
twice or more in the text, for every length, and inside lines equal to an
earlier line.  A text is rejected when a share passes its limit.

Defined results: null and empty texts have no words, so all measures are 0 and
the base rule rejects them; repeated rows get equal rows; an empty table gives
an empty table; the measures come in one struct column under a name that no
input column has, so clashing names are kept.  Memory is bounded by the longest
text (``textnum``).  Equality of n-grams and lines is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.llm import textnum as X
from txrisk.llm.common import free_name

LENGTHS = (5, 6, 7, 8, 9, 10)
#: Share of word characters inside duplicated n-grams, by n, that a text may have.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: The same for lines with a word that equal an earlier line, of lines and of their characters.
LINE_LIMIT, LINE_CHAR_LIMIT = 0.30, 0.20
#: Base rule.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "line_chars", "n_dup_lines",
            "dup_line_chars", "n_repeat_words", *[f"dup_chars_{n}" for n in LENGTHS]]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _doubled(keys: np.ndarray) -> np.ndarray:
    """Where ``keys`` holds a value that occurs twice or more."""
    s = np.sort(keys)
    twice = s[1:][s[1:] == s[:-1]]
    return np.isin(keys, twice) if len(twice) else np.zeros(len(keys), bool)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def measure_block(b: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of every text of a block."""
    start, end, first = X.words(b, off)
    hashes = X.SpanHash(b)
    chars = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80, dtype=np.int64)])
    length = chars[end] - chars[start]
    text = X.text_of(first)
    salt = X.mix(np.arange(len(off), dtype=np.uint64) + np.uint64(0x51ED270B))
    out = {"n_words": np.diff(first), "word_chars": _sums(length, first),
           "n_symbols": _sums(_SYMBOL[b], off)}

    # lines: cut at \n and at the ends of texts
    cut = np.flatnonzero(b == 10)
    begins = np.union1d(off[:-1], cut + 1)  # a text that ends in \n ends in an empty line
    ends = np.searchsorted(cut, begins)
    nxt = np.append(off[1:], len(b))
    owner = np.searchsorted(off, begins, "right") - 1
    owner = np.minimum(owner, len(off) - 2)
    stop = np.minimum(np.append(cut, len(b))[ends], nxt[owner])
    with_word = np.searchsorted(start, stop) > np.searchsorted(start, begins)
    begins, stop, owner = begins[with_word], stop[with_word], owner[with_word]
    keys = hashes.of(begins, stop) ^ salt[owner]
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    line_chars = chars[stop] - chars[begins]
    n = len(off) - 1
    count = lambda w: np.bincount(owner, w, n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)
    out |= {"n_lines": count(np.ones(len(owner))), "line_chars": count(line_chars),
            "n_dup_lines": count(again), "dup_line_chars": count(line_chars * again)}

    # n-grams: a longer one repeats only where its first five words do
    h = hashes.of(start, end)
    grown = text
    word_at = np.arange(len(h))
    for n_ in LENGTHS:
        covered = np.zeros(len(h), bool)
        if len(h) >= n_:
            grams = X.ngrams(h, n_)
            own = text[:len(grams)]
            inside = own == text[n_ - 1:]
            if n_ > LENGTHS[0]:
                inside &= grown[:len(grams)]
            at = word_at[:len(grams)][inside]
            twice = _doubled(grams[at] ^ salt[own[at]])
            at = at[twice]
            starts = np.zeros(len(h), bool)
            starts[at] = True
            step = np.zeros(len(h) + 1, np.int32)
            step[at] += 1
            step[at + n_] -= 1
            covered = np.cumsum(step[:-1]) > 0
            grown = starts
        else:
            grown = np.zeros(len(h), bool)
        out[f"dup_chars_{n_}"] = _sums(length * covered, first)
        if n_ == 5:
            out["n_repeat_words"] = _sums(covered, first)
    return out


def _measures(texts: pa.Array) -> pa.StructArray:
    parts: dict[str, list] = {m: [] for m in MEASURES}
    for _, b, off in X.blocks(texts):
        for m, v in measure_block(b, off).items():
            parts[m].append(v)
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(v) if v else np.zeros(0), pa.int64()) for v in parts.values()],
        names=MEASURES)


def repetition(df: DataFrame, text: str = "text", name: str = "quality") -> tuple[DataFrame, str]:
    """``df`` with a struct column of ``MEASURES``; also that column's name."""
    name = free_name(df, name)
    struct = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    schema = T.StructType([*df.schema.fields, T.StructField(name, struct)])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _measures(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema), name


def base_failed(m: str) -> Column:
    """Too few words, or too many of them inside repeated five-word windows."""
    return ((F.col(f"{m}.n_words") < MIN_WORDS)
            | (100 * F.col(f"{m}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{m}.n_words")))


def rejected(m: str) -> Column:
    """The base rule, or a share of repeated characters or lines over its limit."""
    out = base_failed(m)
    for n, most in NGRAM_LIMITS.items():
        out |= F.col(f"{m}.dup_chars_{n}") > most * F.col(f"{m}.word_chars")
    return (out | (F.col(f"{m}.n_dup_lines") > LINE_LIMIT * F.col(f"{m}.n_lines"))
            | (F.col(f"{m}.dup_line_chars") > LINE_CHAR_LIMIT * F.col(f"{m}.line_chars")))


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules don't reject, with its own columns."""
    out, m = repetition(df, text)
    return out.where(~rejected(m)).drop(m)


def quality_digest(docs: DataFrame) -> DataFrame:
    """One row per document: base measures, base verdict and verdict."""
    out, m = repetition(docs.select("doc_id", "text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *[F.col(f"{m}.{c}").alias(c) for c in base],
                      base_failed(m).alias("base_failed"), (~rejected(m)).alias("kept"),
                      *[F.col(f"{m}.dup_chars_{n}").alias(f"dup_chars_{n}") for n in LENGTHS])
