"""Vectorised words and rolling hashes over the bytes of many texts at once.

A *block* is a run of whole texts of an Arrow column, joined byte for byte.
Words, word hashes and n-gram hashes of all its texts come from a few numpy
passes; nothing loops over words.  Blocks hold ``BLOCK_BYTES`` at most, except
that a longer text is a block of its own, so memory is bounded by the longest
text and not by the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20
_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_P = _U(0x9E3779B97F4A7C15)
_PINV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        step = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        step[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(step)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the first text, bytes, offsets of the texts in them), of ``size`` bytes
    at most unless a text is longer."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def span_hash(b: np.ndarray) -> "SpanHash":
    return SpanHash(b)


class SpanHash:
    """Hashes of byte ranges of a block, equal for equal bytes."""

    def __init__(self, b: np.ndarray):
        self.inv = powers(_PINV, len(b) + 1)
        self.sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * powers(_P, len(b)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inv[start]
        return mix(h + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def words(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of each text (one more
    entry than texts)."""
    inside = ~SPACE[b]
    edge = np.zeros(len(b) + 1, bool)  # a text begins here
    edge[off] = True
    before = np.concatenate([[False], inside[:-1]]) if len(b) else inside
    after = np.concatenate([inside[1:], [False]]) if len(b) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, off)


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of every ``n`` consecutive word hashes (texts not regarded)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(_P, len(h)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * powers(_PINV, len(h) + 1 - n) + _U(n))


def text_of(first: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
