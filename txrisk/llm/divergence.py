"""Source divergence audit: how the terms of each source of a language differ
from those of its other sources and of the whole language.

A term is a run of ASCII letters and of characters beyond ASCII, A-Z lower-cased.
A term of a language is kept if at least ``MIN_DOCS`` rows of the language have it.
With ``count`` occurrences in a group (a source of a language, or a language as a
whole), ``N`` of all kept terms there and ``V`` kept terms,
``p = 1 + floor(SCALE * (count + 1) / (N + V))``; the divergence of a term is
``floor((p - q)**2 / q)``.  All of it is integer arithmetic.

Counting runs in numpy, in buckets by the length of a term in bytes: up to 8 bytes
are one uint64 and up to 16 two, which are radix-sorted and run-counted; longer
terms go to buckets of byte strings of 32, 64, ... bytes, sorted as bytes.  A task
merges the counts of its blocks and hands them on when it holds ``TASK_TERMS`` of
them, so its memory is bounded by that and by the longest text.

Defined results: a null text, lang or source is ''; equal rows count as documents
of their own; a group without terms has its rows of part ``pair``; a language
without kept terms has the value 0 in all of them; ties of a value go by the bytes
of the item; an empty table gives no rows.  The numbers of the sources of one
language (their totals, and a table of sources by sources) must fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import written
from txrisk.llm.textnum import LOWER, blocks

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Distinct (group, term) counts that a task keeps before it hands them on.
TASK_TERMS = 1 << 20
_CELLS = 1 << 21  # of a block of terms by sources

_TERM = np.zeros(256, bool)
_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_U = np.uint64
_COUNTS = "lang string, source string, term string, n long, docs long"


def _spans(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text of every term of a block."""
    inside = np.zeros(len(b) + 2, bool)
    inside[1:-1] = _TERM[b]
    edge = np.zeros(len(b) + 1, bool)
    edge[off] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return start, end - start, np.searchsorted(off, start, "right") - 1


def _radix(columns: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows of uint64 columns, the first one most significant:
    passes over 16 bits each, without those in which all rows agree."""
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        for shift in range(0, 64, 16):
            digit = (column >> _U(shift)).astype(np.uint16)
            if digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where a row of sorted columns differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _order(columns: list[np.ndarray]) -> np.ndarray:
    if columns[-1].dtype.kind == "S":  # long terms: by bytes, then by group
        order = np.argsort(columns[-1], kind="stable")
        return order[_radix([columns[0][order]])]
    return _radix(columns)


class _Tally:
    """Counts by (group, term) of one bucket: sorted runs of key columns (the group
    first) with occurrences and documents."""

    def __init__(self):
        self.parts: list[tuple[list[np.ndarray], np.ndarray, np.ndarray]] = []

    def add(self, columns: list[np.ndarray], text: np.ndarray) -> None:
        order = _order(columns)
        columns = [c[order] for c in columns]
        new = _runs(columns)
        at = np.flatnonzero(new)
        doc = text[order]  # texts are in order within a run
        new[1:] |= doc[1:] != doc[:-1]
        self.parts.append(([c[at] for c in columns], np.diff(np.append(at, len(order))),
                           np.add.reduceat(new.astype(np.int64), at)))

    def rows(self) -> int:
        return sum(len(n) for _, n, _ in self.parts)

    def merge(self) -> None:
        if len(self.parts) > 1:
            columns = [np.concatenate(c) for c in zip(*[p[0] for p in self.parts])]
            n, docs = (np.concatenate([p[i] for p in self.parts]) for i in (1, 2))
            order = _order(columns)
            columns = [c[order] for c in columns]
            at = np.flatnonzero(_runs(columns))
            self.parts = [([c[at] for c in columns], np.add.reduceat(n[order], at), np.add.reduceat(docs[order], at))]


def _strings(columns: list[np.ndarray]) -> pa.Array:
    """Terms of key columns; no term holds a NUL, so padding is what is zero."""
    if columns[0].dtype.kind == "S":
        raw = np.ascontiguousarray(columns[0]).view(np.uint8).reshape(len(columns[0]), -1)
    else:
        raw = np.stack(columns, 1).astype(">u8").view(np.uint8)
    real = raw != 0
    off = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(real.sum(1), out=off[1:])
    return pa.LargeStringArray.from_buffers(len(raw), pa.py_buffer(off), pa.py_buffer(raw[real])).cast(pa.string())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a partition's terms by (lang, source, term)."""
    groups: dict[tuple[str, str], int] = {}
    tallies: dict[int, _Tally] = {}

    def hand_on() -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
        for tally in tallies.values():
            tally.merge()
            for columns, n, docs in tally.parts:
                for i in range(0, len(n), 100_000):
                    cut = slice(i, i + 100_000)
                    code = pa.array(columns[0][cut].astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(code), sources.take(code), _strings([c[cut] for c in columns[1:]]),
                         pa.array(n[cut], pa.int64()), pa.array(docs[cut], pa.int64())],
                        ["lang", "source", "term", "n", "docs"])
        tallies.clear()

    held = 0
    for batch in batches:
        lang, source = (batch.column(i).fill_null("").to_pylist() for i in (1, 2))
        code = np.array([groups.setdefault(g, len(groups)) for g in zip(lang, source)], np.uint64)
        for first, b, off in blocks(batch.column(0)):
            start, length, text = _spans(b, off)
            if not len(start):
                continue
            padded = np.zeros(len(b) + 16, np.uint8)
            padded[:len(b)] = LOWER[b]
            eight = np.ndarray((len(b) + 9,), ">u8", padded, strides=(1,))  # the 8 bytes from each place on
            text += first
            width = np.where(length <= 8, 8, 16)
            long = length > 16
            width[long] = 1 << np.ceil(np.log2(length[long])).astype(np.int64)
            for w in np.unique(width).tolist():
                pick = np.flatnonzero(width == w)
                s, size, t = start[pick], length[pick], text[pick]
                if w <= 16:
                    pad = (8 * (8 - np.minimum(size, 8))).astype(np.uint64)
                    keys = [(eight[s].astype(np.uint64) >> pad) << pad]
                    if w == 16:
                        pad = (8 * (16 - size)).astype(np.uint64)
                        keys.append((eight[s + 8].astype(np.uint64) >> pad) << pad)
                else:
                    raw = np.zeros((len(s), w), np.uint8)
                    for row, i, n in zip(raw, s.tolist(), size.tolist()):  # few terms are that long
                        row[:n] = padded[i:i + n]
                    keys = [raw.view(f"S{w}").ravel()]
                tallies.setdefault(w, _Tally()).add([code[t], *keys], t)
        if sum(t.rows() for t in tallies.values()) > max(TASK_TERMS, 2 * held):
            for t in tallies.values():
                t.merge()
            held = sum(t.rows() for t in tallies.values())
            if held > TASK_TERMS:
                yield from hand_on()
                held = 0
    yield from hand_on()


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def kept_terms(docs: DataFrame) -> DataFrame:
    """(lang, term, groups: array of (source, n)) of the kept terms.  One shuffle,
    by (lang, term); a task sends a count once."""
    counts = _plain(docs).mapInArrow(_count, _COUNTS).repartition("lang", "term")
    by_group = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (by_group.groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("groups"))
            .where(F.col("docs") >= MIN_DOCS).drop("docs"))


def _share(n: Column, total: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / total)`` in decimals, beyond the range of a long."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    return 1 + F.call_function("div", wide, total.cast("decimal(19,0)"))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``_share`` of numpy numbers."""
    if len(n) and int(n.max()) >= (1 << 63) // SCALE - 1:
        n = n.astype(object)
    return 1 + ((n + 1) * SCALE // total).astype(np.int64)


def _pair_sums(meta: dict[str, tuple[list[str], np.ndarray, int]]):
    """Per task and language, the sums over its terms of what each pair of sources
    has beyond the divergence of two sources that both lack the term."""
    def add(sums: np.ndarray, lang: str, term: np.ndarray, source: pa.Array, n: np.ndarray) -> None:
        sources, totals, _ = meta[lang]
        s = pc.index_in(source, pa.array(sources, pa.string())).to_numpy().astype(np.int64)
        none = _shares(np.zeros(len(sources), np.int64), totals)
        p = np.tile(none, (int(term[-1]) + 1, 1))
        has = np.zeros(p.shape, bool)
        p[term, s] = _shares(n, totals[s])
        has[term, s] = True
        base = (none[:, None] - none) ** 2 // none  # [a, b]: a against b, both without the term
        both = has.T.astype(np.float64) @ has
        either = (has.sum(0)[:, None] + has.sum(0) - both).astype(np.int64)
        sums -= either * base
        for i in range(len(sources)):
            rows = np.flatnonzero(has[:, i])
            if len(rows):
                own = p[rows, i][:, None]
                sums[:, i] += ((p[rows] - own) ** 2 // own).sum(0)
                sums[i] += np.where(has[rows], 0, (own - none) ** 2 // none).sum(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            codes, lists = names.indices.to_numpy(), batch.column(1)
            for code, lang in enumerate(names.dictionary.to_pylist()):
                width = len(meta[lang][0])
                of_lang = np.flatnonzero(codes == code)
                step = max(1, _CELLS // width)
                for i in range(0, len(of_lang), step):
                    part = lists.take(pa.array(of_lang[i:i + step]))
                    flat = part.flatten()
                    sizes = pc.list_value_length(part).to_numpy()
                    add(sums.setdefault(lang, np.zeros((width, width), np.int64)), lang,
                        np.repeat(np.arange(len(sizes)), sizes), flat.field("source"), flat.field("n").to_numpy())
        for lang, values in sums.items():
            sources = pa.array(meta[lang][0], pa.string())
            for i in range(len(sources)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(sources)), pa.array([meta[lang][0][i]] * len(sources)), sources,
                     pa.array(values[i])], ["lang", "source", "item", "more"])
    return run


def _ranked(df: DataFrame, part: str, limit: int | None = None) -> DataFrame:
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = df.withColumn("rank", F.row_number().over(w))
    if limit:
        out = out.where(F.col("rank") <= limit)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"),
                      F.col("rank").cast("int").alias("rank"))


def divergence(docs: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has the other sources of
    the language, by the sum of divergences over all kept terms; part ``term`` the
    ``top`` terms that the source has and uses more than the language does, by
    their divergence from it."""
    kept = written(kept_terms(docs), "kept-terms")
    flat = kept.select("lang", "term", F.explode("groups").alias("g")).select("lang", "term", "g.*")
    groups = _plain(docs).select("lang", "source").distinct()
    in_group = flat.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    in_lang = (kept.select("lang", F.aggregate("groups", F.lit(0).cast("long"), lambda a, g: a + g["n"]).alias("n"))
               .groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("v")))
    # one row per source of a language
    totals = written(groups.join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left")
                     .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "lang_n", "v")]), "source-totals")
    meta: dict[str, tuple[list[str], list[int], int]] = {}
    for r in totals.where("v > 0").orderBy("lang", "source").toLocalIterator():
        sources, sizes, _ = meta.setdefault(r["lang"], ([], [], r["v"]))
        sources.append(r["source"])
        sizes.append(r["n"] + r["v"])
    sums = kept.select("lang", "groups").mapInArrow(
        _pair_sums({k: (s, np.array(t, np.int64), v) for k, (s, t, v) in meta.items()}),
        "lang string, source string, item string, more long").groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))
    none = _share(F.lit(0), F.greatest(F.col("n") + F.col("v"), F.lit(1)))
    one = totals.select("lang", "source", "v", none.alias("p"))
    other = totals.select("lang", F.col("source").alias("item"), none.alias("q"))
    pairs = (one.join(other, "lang").where(F.col("source") != F.col("item"))
             .join(sums, ["lang", "source", "item"], "left")
             .withColumn("value", F.coalesce("more", F.lit(0)) + F.col("v") * _apart(F.col("p"), F.col("q"))))

    of_term = kept.select("lang", "term", F.explode("groups").alias("g"),
                          F.aggregate("groups", F.lit(0).cast("long"), lambda a, g: a + g["n"]).alias("all"))
    p = _share(F.col("m"), F.col("n") + F.col("v"))
    q = _share(F.col("all"), F.col("lang_n") + F.col("v"))
    terms = (of_term.select("lang", F.col("g.source").alias("source"), F.col("term").alias("item"), F.col("g.n").alias("m"), "all")
             .join(totals, ["lang", "source"]).select("lang", "source", "item", p.alias("p"), q.alias("q"))
             .where("p > q").withColumn("value", _apart(F.col("p"), F.col("q"))))
    return _ranked(pairs, "pair").unionByName(_ranked(terms, "term", top))
