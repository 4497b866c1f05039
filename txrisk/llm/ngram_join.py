"""N-gram Jaccard join (operator 4).

Documents whose sets of five-word shingles have a Jaccard similarity of 0.75 or
more are linked; returned are the classes that links connect.

1. A document is its set of 64-bit shingle hashes.  Documents with equal sets
   are one class (their key is a hash of the set); only classes are compared.
2. Screen.  By the prefix principle for any fixed order, linked classes share at
   least ``l`` of their first ``n - ceil(0.75 n) + l`` shingles by hash value.
   Tasks credit classes with the shingles of that stretch that another class
   has too, and classes with too few credits for any partner are alone.  A
   shingle leaves a task once, however many classes of the task have it.
3. Join of what is left: shingles are ordered rare first; each class posts its
   prefix of ``n - ceil(0.75 n) + 1`` shingles, without those that no other
   class has.  Members of a posting meet under the length filter and the
   positional filter, distinct pairs are verified once: a filter on the
   suffixes (cutting both lists at the same values bounds the overlap), then the
   exact overlap.  ``linking`` keeps postings of any size from becoming all pairs.

Defined results: null texts and texts without words have the empty set and link
with nothing; repeated rows and ties get the same class; a null id counts in a
class but never names it; an empty table gives no rows; other columns are not
read.  Equality of shingles and sets is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.llm import textnum as X
from txrisk.llm.common import free_name, small_side, written
from txrisk.llm.linking import connected
from txrisk.session import discard, release

N = 5
#: The threshold as a fraction, 75 / 100.
NUM, DEN = 75, 100
#: One in so many shingles more than the least prefix is screened.
STRETCH = 8
#: Shingles that a task holds before it passes them on, or merges them.
HOLD = 1 << 20
#: Postings carry the prefix before them, up to so many shingles, so that a pair is made in one of its groups.
CARRY = 64
_U = np.uint64


def need(n):  # noqa: ANN001, ANN201
    """Shingles that a set of n shares with any linked set, at least."""
    return (NUM * n + DEN - 1) // DEN


def sets_of(texts: pa.Array, n_words: int = N) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for _, raw, off in X.blocks(texts):
        b = X.LOWER[raw]
        start, end, first = X.words(b, off)
        h = X.SpanHash(b).of(start, end)
        grams = X.ngrams(h, n_words)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if hi - lo >= n_words:
                yield np.unique(grams[lo:hi - n_words + 1])
            elif hi > lo:
                yield X.ngrams(h[lo:hi], hi - lo)
            else:
                yield np.zeros(0, np.uint64)


def key_of(s: np.ndarray) -> np.uint64:
    """Hash of a set: of the sum of its mixed members and its size."""
    sized = np.array([len(s)], np.uint64) * _U(0x9E3779B97F4A7C15)
    return X.mix(sized + X.mix(s).sum(dtype=np.uint64))[0]


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key (null without shingles), n of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(len(s), int(key_of(s).view(np.int64)) if len(s) else None) for s in sets_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([k for _, k in got], pa.int64()), pa.array([n for n, _ in got], pa.int64())],
                names=["doc_id", "key", "n"])
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, key long, n long")


def _credited(grams: np.ndarray, keys: np.ndarray, known: np.ndarray, is_new: np.ndarray) -> tuple:
    """Groups equal grams: which entries are shared by two classes or known to
    be shared elsewhere; also one entry of every group."""
    order = np.argsort(grams, kind="stable")
    g, k, f = grams[order], keys[order], known[order]
    begin = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    shared = (np.minimum.reduceat(k, begin) != np.maximum.reduceat(k, begin)) | np.logical_or.reduceat(f, begin)
    each = np.repeat(shared, np.diff(np.append(begin, len(g))))
    credit = k[each & (is_new[order] | ~f)]
    return g[begin], k[begin], shared, credit


def even_buckets(spark: SparkSession, buckets: int) -> list[int]:
    """A number for each of ``buckets`` partitions that a shuffle deals to it, so that
    every partition gets one bucket."""
    place = F.pmod(F.hash("id"), F.lit(buckets))
    of = {}
    wide = 16 * buckets
    while len(of) < buckets:
        of = {r["p"]: r["id"] for r in spark.range(wide).groupBy(place.alias("p")).agg(F.min("id").alias("id")).collect()}
        wide *= 2
    return [of[p] for p in range(buckets)]


def _packed(grams: np.ndarray) -> bytes:
    """The low 48 bits of hashes: enough for the screen, where a chance match costs a
    credit too many and never one too few."""
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def screen(docs: DataFrame, buckets: int) -> DataFrame:
    """key, credit: no fewer than the shingles in the class's stretch that
    another class has in its own."""
    number = even_buckets(docs.sparkSession, buckets)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = turn = 0

        def out() -> pa.RecordBatch:
            grams = np.concatenate(list(held.values()))
            keys = np.repeat(np.array(list(held), np.uint64), [len(v) for v in held.values()])
            none = np.zeros(len(grams), bool)
            g, k, shared, credit = _credited(grams, keys, none, ~none)
            ids, counts = np.unique(credit, return_counts=True)
            own = (g % _U(buckets)).astype(np.int64)
            order = np.lexsort((k, own))
            g, k, shared, own = g[order], k[order], shared[order], own[order]
            cut = np.searchsorted(own, np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(cut)):
                lo, hi = cut[b], cut[b + 1]
                one = ~shared[lo:hi]
                ks = k[lo:hi][one]  # sorted: named once, with the length of its run
                uniq, runs = np.unique(ks, return_counts=True)
                rows.append((number[b], _packed(g[lo:hi][one]), uniq.tobytes(), runs.astype(np.uint32).tobytes(),
                             _packed(g[lo:hi][~one]), b"", b""))
            rows.append((number[turn % buckets], b"", b"", b"", b"", ids.tobytes(), counts.astype(np.int64).tobytes()))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows, strict=True))],
                names=["bucket", "grams", "keys", "runs", "known", "ids", "counts"])

        for batch in batches:
            for s in sets_of(batch.column(0)):
                if len(s):
                    n = len(s)
                    held[int(key_of(s))] = s[:n - need(n) + 1 + n // STRETCH]
                    size += n // 2
                    if size >= HOLD:
                        yield out()
                        held, size, turn = {}, 0, turn + 1
        if held:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One pass over a partition's postings; held are its distinct shingles, and
        the credits of up to ``HOLD`` classes, which leave it once."""
        state = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool)]
        new: list[tuple] = []
        size = 0
        credits: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            ids, at = np.unique(np.concatenate([i for i, _ in credits]), return_inverse=True)
            return ids, np.bincount(at, np.concatenate([c for _, c in credits])).astype(np.int64)

        def add(ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            credits.append((ids, counts))
            if sum(len(i) for i, _ in credits) > HOLD:
                credits[:] = [summed()]
                if 2 * len(credits[0][0]) > HOLD:
                    yield from pass_on()

        def pass_on() -> Iterator[pa.RecordBatch]:
            """A row for each partition of classes: their ids and credits."""
            if credits:
                ids, counts = summed()
                own = (X.mix(ids) % _U(buckets)).astype(np.int64)
                order = np.argsort(own, kind="stable")
                cut = np.searchsorted(own[order], np.arange(buckets + 1))
                sent = [(number[b], ids[order[i:j]].tobytes(), counts[order[i:j]].tobytes())
                        for b, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if j > i]
                if sent:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.binary() if i else pa.int64()) for i, c in enumerate(zip(*sent, strict=True))],
                        names=["bucket", "ids", "counts"])
            credits.clear()

        def fold() -> tuple[np.ndarray, np.ndarray]:
            grams, keys, known = (np.concatenate([state[i], *[x[i] for x in new]]) for i in range(3))
            is_new = np.arange(len(grams)) >= len(state[0])
            # what is known to be shared names no class to credit
            is_new &= ~known
            g, k, shared, credit = _credited(grams, keys, known, is_new)
            state[:] = [g, k, shared]
            return np.unique(credit, return_counts=True)

        for batch in batches:
            for _, grams, keys, runs, known, ids, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if ids:
                    yield from add(np.frombuffer(ids, np.uint64), np.frombuffer(counts, np.int64))
                g = _unpacked(grams)
                k = np.repeat(np.frombuffer(keys, np.uint64), np.frombuffer(runs, np.uint32))
                s = _unpacked(known)
                new += [(g, k, np.zeros(len(g), bool)), (s, np.zeros(len(s), np.uint64), np.ones(len(s), bool))]
                size += len(g) + len(s)
                if size >= max(HOLD, len(state[0])):
                    yield from add(*fold())
                    new, size = [], 0
        if new:
            yield from add(*fold())
        yield from pass_on()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The credits of a partition's classes."""
        got = [(np.frombuffer(i, np.uint64), np.frombuffer(c, np.int64)) for batch in batches
               for i, c in zip(batch.column("ids").to_pylist(), batch.column("counts").to_pylist(), strict=True)]
        if got:
            ids, at = np.unique(np.concatenate([i for i, _ in got]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([c for _, c in got])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([_signed(ids), pa.array(sums)], names=["key", "credit"])

    posted = docs.select("text").mapInArrow(
        post, "bucket long, grams binary, keys binary, runs binary, known binary, ids binary, counts binary")
    merged = posted.repartition(buckets, "bucket").mapInArrow(merge, "bucket long, ids binary, counts binary")
    return merged.repartition(buckets, "bucket").mapInArrow(total, "key long, credit long")


def _needed(n: Column) -> Column:
    return F.floor((n * NUM + (DEN - 1)) / DEN).cast("long")


def _enough(n_a: Column, n_b: Column) -> Column:
    """Least overlap of linked sets of these sizes."""
    return F.ceil((n_a + n_b) * NUM / (NUM + DEN))


def class_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """key, n, grams (list) of the classes (key, doc_id of a member)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(sets_of(batch.column(1)))
            if sets:
                same = [len(s) > 0 and int(key_of(s).view(np.int64)) == k
                        for s, k in zip(sets, batch.column(0).to_pylist(), strict=True)]
                sets = [s if ok else s[:0] for s, ok in zip(sets, same, strict=True)]
                off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                grams = pa.ListArray.from_arrays(pa.array(off), _signed(np.concatenate(sets)))
                got = pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), grams], names=["key", "n", "grams"])
                yield got.filter(pa.array(same))
    named = small_side(classes.select("key", F.col("doc_id").alias("_id")))  # texts stay in place while these are few
    texts = docs.select("doc_id", "text").join(named, F.col("doc_id").eqNullSafe(F.col("_id"))).select("key", "text")
    return texts.mapInArrow(run, "key long, n long, grams array<long>")


def ordered(sets: DataFrame) -> DataFrame:
    """key, n, prefix (rare first, singles left out), tokens (shared ones by
    value) of the classes that share enough shingles to have a partner."""
    # a count over a window: every shingle is shuffled once, not once to be counted and once to be joined
    postings = sets.select("key", F.explode_outer("grams").alias("gram"))
    frequency = F.count(F.lit(1)).over(Window.partitionBy("gram"))
    rare = (postings.withColumn("df", frequency).where("df > 1").groupBy("key")
            .agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("t"))
            .join(sets.select("key", "n"), "key"))
    shared = F.size("t")
    return (rare.where(shared >= _needed(F.col("n")))
            .select("key", "n", shared.alias("shared"), F.transform("t", lambda x: x["gram"]).alias("t"))
            .select("key", "n", "shared",
                    F.slice("t", F.lit(1), (F.col("shared") - _needed(F.col("n")) + 1).cast("int")).alias("prefix"),
                    F.sort_array("t").alias("tokens")))


#: Value ranges of the suffix filter, and shingles of the documents of one side of a cell.
RANGES, CELL = 16, 1 << 21


def _linked(n: np.ndarray, tokens: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs (places a, b) of documents with ``n`` shingles and these shared ones
    (sorted) have the overlap they need.  The suffix filter first: lists cut at the
    same values can't overlap more than the shorter part of each cut.  Then the exact
    overlap, for all partners of a document at once."""
    least = -(-NUM * (n[a] + n[b]) // (NUM + DEN))
    cuts = np.linspace(-(1 << 63), (1 << 63) - 1, RANGES + 1)[1:-1].astype(np.int64)
    parts = np.diff(np.array([np.concatenate([[0], np.searchsorted(t, cuts), [len(t)]]) for t in tokens]), axis=1)
    out = np.zeros(len(a), bool)
    open_ = np.flatnonzero(np.minimum(parts[a], parts[b]).sum(1) >= least)
    size = np.array([len(t) for t in tokens])
    first = np.cumsum(size) - size
    _, code = np.unique(np.concatenate(tokens), return_inverse=True)
    mark = np.zeros(int(code.max(initial=-1)) + 1, bool)
    open_ = open_[np.argsort(a[open_], kind="stable")]
    for part in np.split(open_, np.flatnonzero(np.diff(a[open_])) + 1):
        if len(part):
            x = a[part[0]]
            own = code[first[x]:first[x] + size[x]]
            mark[own] = True
            for some in np.split(part, range(256, len(part), 256)):
                ends = np.cumsum(size[b[some]])
                at = np.arange(ends[-1]) + np.repeat(first[b[some]] - (ends - size[b[some]]), size[b[some]])
                hits = np.concatenate([[0], np.cumsum(mark[code[at]])])
                out[some] = hits[ends] - hits[ends - size[b[some]]] >= least[some]
            mark[own] = False
    return out


def verifier(lists: DataFrame):  # noqa: ANN201
    """Keeps the linked pairs of (a, b).  Pairs meet in cells of a block of documents
    by another, so that a document is sent once for all its pairs of a cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                pairs, docs = (batch.column(c)[row].values for c in ("pairs", "docs"))
                ids = docs.field("key").to_numpy()
                order = np.argsort(ids)
                a, b = (order[np.searchsorted(ids, pairs.field(c).to_numpy(), sorter=order)] for c in ("a", "b"))
                tokens = [t.values.to_numpy() for t in docs.field("tokens")]
                keep = _linked(docs.field("n").to_numpy(), tokens, a, b)
                kept = pairs.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([kept.field("a"), kept.field("b")], names=["a", "b"])

    total = lists.agg(F.sum(F.size("tokens"))).first()[0] or 0
    blocks = max(1, -(-total // CELL))

    def verify(pairs: DataFrame) -> DataFrame:
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
        placed = pairs.select("a", "b", block("a").alias("ba"), block("b").alias("bb"))
        cells = placed.groupBy("ba", "bb").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
        ends = placed.select("ba", "bb", F.explode(F.array("a", "b")).alias("key")).distinct()
        docs = (ends.join(lists.select("key", "n", "tokens"), "key").groupBy("ba", "bb")
                .agg(F.collect_list(F.struct("key", "n", "tokens")).alias("docs")))
        return cells.join(docs, ["ba", "bb"]).select("pairs", "docs").mapInArrow(run, "a long, b long")
    return verify


def _may_link(x: Column, y: Column) -> Column:
    least = _enough(x["n"], y["n"])
    length = (F.least(x["n"], y["n"]) * DEN >= F.greatest(x["n"], y["n"]) * NUM)
    room = (F.least(x["pos"], y["pos"]) + 1 + F.least(x["n"] - x["pos"], y["n"] - y["pos"]) - 1)
    return length & (room >= least)


def _met_before(x: Column, y: Column) -> Column:
    """Prefixes are in one order, so the first common shingle of one is that of the other."""
    return F.coalesce(F.arrays_overlap(x["before"], y["before"]), F.lit(False))


#: Members of a group that are compared at once in the last round, and bits of a mark.
BLOCK, MARK_BITS = 256, 1024


def marks(lists: DataFrame) -> DataFrame:
    """id, s (number of shared shingles), mark (bits of their values) of every class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [t.values.to_numpy() for t in batch.column("tokens")]
            bits = np.zeros((len(tokens), MARK_BITS), bool)
            for row, t in zip(bits, tokens, strict=True):
                row[t & (MARK_BITS - 1)] = True
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([len(t) for t in tokens], pa.int64()),
                 pa.array([r.tobytes() for r in np.packbits(bits, axis=1)], pa.binary())], names=["id", "s", "mark"])
    return lists.select("key", "tokens").mapInArrow(run, "id long, s long, mark binary")


def _block_pairs(x: dict[str, np.ndarray], y: dict[str, np.ndarray], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (of x, of y) of members that need comparing: ``_may_link`` holds, they are
    of two classes, they don't meet in an earlier group, and their marks, of which every
    bit that one alone has stands for a shingle that one alone has, don't rule it out."""
    n, pos = (np.minimum.outer(x[c], y[c]) for c in ("n", "pos"))
    after = np.minimum.outer(x["n"] - x["pos"], y["n"] - y["pos"])
    least = -(-np.add.outer(x["n"], y["n"]) * NUM // (NUM + DEN))
    ok = (x["comp"][:, None] != y["comp"]) & (n * DEN >= np.maximum.outer(x["n"], y["n"]) * NUM) & (pos + after >= least)
    if same:
        ok = np.triu(ok, 1)
    if ok.any():
        grams, code = np.unique(np.concatenate([x["before"], y["before"]]), return_inverse=True)
        rows = []
        for side, own in ((x, code[:len(x["before"])]), (y, code[len(x["before"]):])):
            has = np.zeros((len(side["n"]), len(grams)), np.float32)
            has[np.repeat(np.arange(len(side["n"])), side["before_n"]), own] = 1
            rows.append(has)
        ok &= rows[0] @ rows[1].T == 0
    i, j = np.nonzero(ok)
    apart = np.bitwise_count(x["mark"][i] ^ y["mark"][j]).sum(1, dtype=np.int64)
    near = apart <= x["s"][i] + y["s"][j] - 2 * least[i, j]
    return i[near], j[near]


def _side(column: pa.ListArray, row: int) -> dict[str, np.ndarray]:
    cells = column[row].values
    out = {c: cells.field(c).to_numpy() for c in ("id", "comp", "n", "pos", "s")}
    out["mark"] = np.frombuffer(b"".join(cells.field("mark").to_pylist()), np.uint64).reshape(-1, MARK_BITS // 64)
    before = cells.field("before")  # null: not carried, so it meets no one there
    return out | {"before": before.flatten().to_numpy(), "before_n": pc.fill_null(pc.list_value_length(before), 0).to_numpy()}


def rest_of(members: DataFrame, marked: DataFrame) -> DataFrame:
    """Pairs (a, b) of a group's members, block by block, in numpy: a task holds two
    blocks and hands on only the pairs that need comparing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row in range(batch.num_rows):
                x = _side(batch.column("x"), row)
                same = not batch.column("y")[row].is_valid
                y = x if same else _side(batch.column("y"), row)
                i, j = _block_pairs(x, y, same)
                a.append(x["id"][i])
                b.append(y["id"][j])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    blocks = F.floor((F.col("size") + (BLOCK - 1)) / BLOCK)
    cells = (members.join(marked, "id").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
             .groupBy("grp", "block", "blocks").agg(F.collect_list(F.struct("id", "comp", "n", "pos", "s", "mark", "before")).alias("x")))
    cells = written(cells, "blocks")
    own = cells.select("x", F.lit(None).cast(cells.schema["x"].dataType).alias("y"))
    first = cells.where("blocks > block + 1").select("grp", "x", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)).alias("other"))
    second = cells.where("blocks > 1").select("grp", F.col("block").alias("other"), F.col("x").alias("y"))
    both = first.join(second, ["grp", "other"]).select("x", "y")
    return own.unionByName(both).mapInArrow(run, "a long, b long")


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, key, n) of all documents; (key, root) of linked classes; links."""
    docs = docs.select("doc_id", "text")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = written(keyed(docs), "keyed")
    credit = screen(docs, buckets)
    # a partner has need(n) shingles at least, and shares as many as its own stretch asks for
    open_ = (every.where("key is not null").groupBy("key", "n").agg(F.min("doc_id").alias("doc_id"))
             .join(credit, "key").where(F.col("credit") >= 1 + F.floor(_needed(F.col("n")) / STRETCH)))
    open_ = written(open_.select("key", "doc_id"), "open")
    release(docs.sparkSession)
    sets = class_sets(docs, open_)
    if every.groupBy("doc_id", "key").count().where("count > 1").take(1):
        sets = sets.dropDuplicates(["key"])  # rows that repeat an id
    sets = written(sets, "sets")
    lists = written(ordered(sets), "lists")
    discard(open_)
    discard(sets)
    release(docs.sparkSession)
    members = lists.select(F.col("key").alias("id"), "n", "shared", "prefix",
                           F.posexplode_outer("prefix").alias("at", "grp")) \
        .withColumn("before", F.when(F.size("prefix") <= CARRY, F.slice("prefix", F.lit(1), F.col("at")))) \
        .select("grp", "id", "n", (F.col("n") - F.col("shared") + F.col("at")).alias("pos"), "before")
    roots, links = connected(members, _may_link, verifier(lists), ["n", "pos", "before"], _met_before,
                             lambda left: rest_of(left, marks(lists)))
    discard(lists)
    return every, roots.select(F.col("id").alias("key"), "root"), links


def component_ids(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    every, roots, _ = classes(docs)
    first = every.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first"))
    linked = roots.join(first, "key")
    named = linked.join(linked.groupBy("root").agg(F.min("first").alias("named")), "root").select("key", "named")
    of_class = written(first.join(small_side(written(named, "named")), "key", "left")
                       .select("key", F.coalesce("named", "first").alias("component_id")), "components")
    return every.join(small_side(of_class), "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id, and
    one row of it.  Documents without an id stay only if no other member has one."""
    id_ = free_name(docs, "_id")
    kept = written(component_ids(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias(id_)), "kept")
    out = docs.join(small_side(kept.distinct()), F.col("doc_id").eqNullSafe(F.col(id_)))
    out = out.select(*[docs[c] for c in docs.columns])
    if kept.groupBy(id_).count().where("count > 1").take(1):
        out = out.dropDuplicates(["doc_id"])
    return out
