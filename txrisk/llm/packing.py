"""Best-fit packing (operator 10).

Documents become token ids plus an end id; those longer than a sequence are cut
into pieces of full length, the first piece taking the rest.  Pieces are packed
into sequences by best fit, the longest first: a piece goes to the smallest gap
that holds it.

Best fit by counts, in place of distributed sweeps over range-sorted pieces and
gaps.  Pieces have a rank within their length, sequences one within their gap.
In a superstep the pieces of the longest length left take their successor gaps: the r-th piece of the
class gets the place of rank r among the gaps of the smallest class that holds
it (so no two pieces want one place), those gaps shrink to their new class, and
the step repeats until the pieces are placed.  As pieces of one length and gaps
of one size are alike, a superstep is a matter of counts: its state are two
histograms of at most ``seq_len`` classes, which bound what the driver sees
whatever the input, and the supersteps run there.  Their plan is broadcast: a gap
that a length uses is more than halved, and a length leaves at most three new
kinds of gaps, so the plan has at most 32 rows a length for sequences of 1024.
Spark does the rows: tokens, pieces, the histogram, the
rank of each piece (by hash buckets, so that no task sees a whole class), and
one join by (length, range of ranks) that gives each piece its place.

Defined results: null and empty texts are one piece, the end id; repeated rows
are packed each; a null id is an id; an empty table gives no rows; other
columns are not read; the strings of special tokens in a text become their ids.
A text is tokenized whole, in the memory of one task.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import running_start, written

SEQ_LEN = 1024
END_ID = 2
#: Distinct words whose ids a worker keeps; beyond it starts anew.
CACHE_WORDS = 400_000
#: Characters of text that are turned into ids at once (a longer text is by itself).
STEP_CHARS = 1 << 22

# The characters that are white space to a tokenizer's pattern.
_SPACES = (r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# White space next to a space, or at an end: a cut at single spaces might then part one token.
_UNEVEN = rf"[{_SPACES}] | [{_SPACES}]|\A[{_SPACES}]|[{_SPACES}]\z"


def default_tokenizer() -> str:
    """The vocabulary of byte_bpe_50k.json as ranks: the same ids, found several
    times as fast (a test holds the two against each other)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _json(path: str) -> str:
    """The file of the tokenizers library with the vocabulary of ``path``."""
    return path.removesuffix(".tiktoken") + ".json" if path.endswith(".tiktoken") else path


def special_strings(path: str) -> list[str]:
    """Strings that have an id of their own wherever a text holds them."""
    if not os.path.exists(_json(path)):  # ranks alone have none
        return []
    with open(_json(path), encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens") or []]


def _encoder(path: str):  # noqa: ANN202
    """words -> lists of ids, by a file of ranks or of the tokenizers library;
    strings of special tokens are ordinary text here (see ``Ids``)."""
    if path.endswith(".tiktoken"):
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(w): int(r) for w, r in map(bytes.split, f)}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda words: [own.encode_ordinary(w) for w in words]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda words: [e.ids for e in t.encode_batch_fast(words, add_special_tokens=False)]


class Ids:
    """Token ids of texts by a tokenizer file.

    A byte-level vocabulary never joins a letter with the space after it, so a
    text whose spaces stand alone is cut before each of them, and a word's ids
    are looked up once for all its occurrences.  A text that holds one of the
    ``special`` strings goes through the tokenizers library as it is.
    """

    def __init__(self, path: str, special: list[str] | None = None):
        self.encode = _encoder(path)
        self.path, self.whole = path, None
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.clear()

    def _with_special(self, text: str) -> np.ndarray:
        if self.whole is None:
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(_json(self.path))
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.size = np.zeros(1 << 16, np.int64)
        self.start = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        at = len(self.place)
        got = self.encode(words)
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        while at + len(got) > len(self.size):
            self.size, self.start = (np.concatenate([x, np.zeros(len(x), np.int64)]) for x in (self.size, self.start))
        total = int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.size[at:at + len(got)] = sizes
        self.start[at:at + len(got)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used:self.used + total] = [i for ids in got for i in ids]
        self.used += total
        self.place.update(zip(words, range(at, at + len(got)), strict=True))

    def of(self, texts: list[str]) -> list[np.ndarray]:
        own = {i: self._with_special(t) for i, t in enumerate(texts) if self.special.search(t)} if self.special else {}
        if not own:
            return self._of_words(texts)
        rest = iter(self._of_words([t for i, t in enumerate(texts) if i not in own]))
        return [own[i] if i in own else next(rest) for i in range(len(texts))]

    def _of_words(self, texts: list[str]) -> list[np.ndarray]:
        """Words are cut and told apart in Arrow; a word is looked up once a call."""
        if len(self.place) > CACHE_WORDS:
            self.clear()
        column = pa.array(texts, pa.large_string())
        uneven = pc.match_substring_regex(column, _UNEVEN)
        cut = pc.split_pattern(column.filter(pc.invert(uneven)), " ")
        coded = cut.flatten().dictionary_encode()
        code, known = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        begin = bounds[:-1]  # the first word of a text has no space before it
        heads = [known[i] for i in code[begin].tolist()]
        spaced = [f" {w}" for w in known]
        whole = column.filter(uneven).to_pylist()
        new = {w for words in (heads, spaced, whole) for w in words} - self.place.keys()
        if new:
            self._learn(sorted(new))
        find = lambda words: np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        at = find(spaced)[code] if len(known) else np.zeros(0, np.int64)
        at[begin] = find(heads)
        cuts = iter(self._joined(at, bounds))
        alone = iter(self._joined(find(whole), np.arange(len(whole) + 1)))
        return [next(alone if u else cuts) for u in uneven.to_pylist()]

    def _joined(self, at: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """The ids of words at ``at``, one after the other, by text."""
        size = self.size[at]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[at] - (ends - size), size)]
        ends = np.concatenate([[0], ends])[bounds]
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def cut_points(n: int, seq_len: int) -> list[tuple[int, int]]:
    """[start, end) of the pieces of n tokens: the first takes what full ones leave."""
    if n <= seq_len:
        return [(0, n)]
    first = n % seq_len
    return [(0, first)] * (first > 0) + [(s, s + seq_len) for s in range(first, n, seq_len)]


def pieces(docs: DataFrame, tokenizer: str | None = None, seq_len: int = SEQ_LEN) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    path = tokenizer or default_tokenizer()
    special = special_strings(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(path, special)
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            rows = []
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to]) <= STEP_CHARS):
                    chars += len(texts[to])
                    to += 1
                for i, got in enumerate(ids.of(texts[at:to]), at):
                    got = np.append(got, np.uint32(END_ID)).astype("<u4")
                    rows += [(i, p, s, e - s, zlib.crc32(got[s:e].tobytes()))
                             for p, (s, e) in enumerate(cut_points(len(got), seq_len))]
                at = to
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in cols[2:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def supersteps(counts: dict[int, int], seq_len: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces: rows (length, from rank, to rank,
    first sequence, pieces a sequence, offset of the first of them)."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # by gap: (first sequence, how many)
    sizes: list[int] = []  # the gaps there are, sorted
    plan, sequences = [], 0

    def put(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)  # the successor gap
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(at)
            else:
                gap, first, n = seq_len, sequences, -(-left // (seq_len // length))
                sequences += n
            each = gap // length
            full = min(n, left // each)
            if full:
                plan.append((length, rank, rank + full * each, first, each, seq_len - gap))
                put(gap - each * length, first, full)
            rank, left = rank + full * each, left - full * each
            if full < n and left < each:
                if left:  # the last sequence takes what is left
                    plan.append((length, rank, rank + left, first + full, left, seq_len - gap))
                    put(gap - left * length, first + full, 1)
                    full, left = full + 1, 0
                put(gap, first + full, n - full)
    return plan


def pack(cut: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """``cut`` (doc_id, piece, start, length, ids_crc32; a written table) with
    sequence_id and offset."""
    spark = cut.sparkSession
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # seq_len rows at most
    plan = supersteps(counts, seq_len)
    places = F.broadcast(spark.createDataFrame(
        plan, "_length long, lo long, hi long, first long, each long, at long"))
    key = F.xxhash64("doc_id", "piece", "ids_crc32")
    ranked = running_start(cut.withColumn("_key", key), ["length"],
                           [F.col("_key"), F.col("doc_id"), F.col("piece")], F.lit(1), "_rank", 64)
    on = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    nth = F.col("_rank") - F.col("lo")
    return ranked.join(places, on).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (nth % F.col("each")) * F.col("length")).cast("long").alias("offset"))


def packed(docs: DataFrame, tokenizer: str | None = None, seq_len: int = SEQ_LEN) -> DataFrame:
    return pack(written(pieces(docs, tokenizer, seq_len), "pieces"), seq_len)
