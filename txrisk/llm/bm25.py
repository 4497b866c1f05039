"""Exact top-k search (operator 7).

Documents are cut into shards of at most ``SHARD_DOCS`` documents and about
``SHARD_POSTINGS`` postings, each an inverted index of its own: sorted term hashes
and postings by (term, document); in memory a term that many documents have is a
row of impacts with the largest impact of every block of 64 documents.  Document
frequencies and lengths are counted over all shards, so scores are the same in
each.

Queries go over the shards in blocks of bounded size, and over a growing number of
shards in rounds: ``FIRST_SHARDS`` first, then as many as all rounds before had.
After a round the k-th best score of each query so far is the threshold of the
next, so a round finds about k documents a query and not k a shard.  In a shard,
block-max WAND prunes by that threshold: common terms are ordered by their largest
possible contribution, and the first ones, which together stay well below the
threshold and can't bring a document into the results by themselves, are left for
later.  The other terms are scored; a document stays open if its score and the
block maxima of the terms left reach the threshold, and only open documents have
those looked up.  A task that holds several shards raises its thresholds as it
goes.  What is left is merged exactly.

A query is a whole document; its terms weigh by how often it has them.  Terms
are words, A-Z lowered, by 64-bit hash.  Scores are BM25 with k1 = 1.2 and
b = 0.75, rounded to 2**-34, so that equal documents tie whatever the order of
addition.  Results go by score, ties by document id.

Defined results: null and empty texts match nothing and, as queries, have no
results; a null id is no query but can be found (last among ties); ids are of any
type; repeated rows are documents of their own; an empty table gives no rows;
other columns are not read.  The index of one text must fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm import textnum as X
from txrisk.llm.common import running_start, written
from txrisk.session import discard

K, K1, B = 10, 1.2, 0.75
SHARD_DOCS, SHARD_POSTINGS, BLOCK_BITS = 8192, 1 << 20, 6
#: Bytes of text that are cut into terms at once.
TEXT_BYTES = 1 << 20
#: Distinct terms of all queries that go over the shards at once.
QUERY_TERMS = 2_000_000
#: Shards of the first round; each later one has as many as all before it.
FIRST_SHARDS = 8
#: One in so many documents of a shard has a common term; the share of the threshold
#: that the largest contributions of the terms left for later may make together.
COMMON, SPLIT = 16, 0.25
#: Queries that a shard scores at once.
AT_ONCE = 32
#: Scores are whole multiples of this; bounds may fall short of a sum by rounding.
_UNIT, _SLACK = 2.0 ** -34, 1e-7


def term_counts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted term hashes of every text, and how often it has them."""
    for _, raw, off in X.blocks(texts, TEXT_BYTES):
        b = X.LOWER[raw]
        start, end, first = X.words(b, off)
        h = X.SpanHash(b).of(start, end)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            yield np.unique(h[lo:hi], return_counts=True)


_PARTS = ["n", "words", "ids", "lengths", "terms", "sizes", "docs", "tfs"]


def _shard(ids: pa.Array, counts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    terms = np.concatenate([t for t, _ in counts])
    tfs = np.concatenate([c for _, c in counts]).astype(np.uint32)
    docs = np.repeat(np.arange(len(counts), dtype=np.uint32), [len(t) for t, _ in counts])
    order = np.argsort(terms, kind="stable")  # documents stay in order within a term
    terms, sizes = np.unique(terms, return_counts=True)
    lengths = np.array([int(c.sum()) for _, c in counts], np.int64)
    own = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    cells = [lengths.tobytes(), terms.tobytes(), sizes.astype(np.uint32).tobytes(), docs[order].tobytes(), tfs[order].tobytes()]
    return pa.RecordBatch.from_arrays(
        [pa.array([len(ids)], pa.int64()), pa.array([int(lengths.sum())], pa.int64()), own,
         *[pa.array([c], pa.binary()) for c in cells]], names=_PARTS)


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard (written): ids and lengths of its documents, its terms
    with their numbers of postings, and the postings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        counts: list = []
        size = 0
        for batch in batches:
            begin = 0
            for i, tc in enumerate(term_counts(batch.column(1))):
                counts.append(tc)
                size += len(tc[0])
                if len(counts) == SHARD_DOCS or size >= SHARD_POSTINGS:
                    yield _shard(pa.concat_arrays([*ids, batch.column(0)[begin:i + 1]]), counts)
                    ids, counts, size, begin = [], [], 0, i + 1
            ids.append(batch.column(0)[begin:])
        if counts:
            yield _shard(pa.concat_arrays(ids), counts)
    kind = dict(docs.dtypes)["doc_id"]
    return written(docs.select("doc_id", "text").mapInArrow(
        run, f"n long, words long, ids array<{kind}>, lengths binary, terms binary, sizes binary, docs binary, tfs binary"), "index")


def frequencies(index: DataFrame) -> DataFrame:
    """term, df over all shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, s in zip(batch.column("terms").to_pylist(), batch.column("sizes").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(t, np.int64)), pa.array(np.frombuffer(s, np.uint32).astype(np.int64))],
                    names=["term", "df"])
    return (index.select("terms", "sizes").mapInArrow(run, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")))


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, term, qtf of the queries (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = list(term_counts(batch.column(1)))
            if got:
                of = np.repeat(np.arange(len(got)), [len(t) for t, _ in got])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of)), pa.array(np.concatenate([t for t, _ in got]).view(np.int64)),
                     pa.array(np.concatenate([c for _, c in got]).astype(np.int64))], names=["query_id", "term", "qtf"])
    kind = dict(queries.dtypes)["doc_id"]
    return queries.select("doc_id", "text").where("doc_id is not null").mapInArrow(run, f"query_id {kind}, term long, qtf long")


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Shard:
    """The index of a shard in memory.  Terms of ``1 / COMMON`` of its documents or more
    are kept as a row of impacts by document, with the largest of each block of
    documents; the others as postings."""

    def __init__(self, row: dict, mean_words: float):
        get = lambda c, t: np.frombuffer(row[c], t)
        self.n, self.terms = row["n"], get("terms", np.uint64)
        sizes = get("sizes", np.uint32).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.docs = get("docs", np.uint32).astype(np.int64)
        tf, long = get("tfs", np.uint32).astype(float), get("lengths", np.int64) / mean_words
        self.impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * long[self.docs]))
        self.peak = np.maximum.reduceat(self.impact, self.first[:-1]) if len(sizes) else self.impact
        common = np.flatnonzero(sizes * COMMON >= self.n)
        self.row = np.full(len(sizes), -1)
        self.row[common] = np.arange(len(common))
        blocks = -(-self.n // (1 << BLOCK_BITS))
        whole = np.zeros((len(common), blocks << BLOCK_BITS))
        for row_, t in zip(whole, common.tolist()):
            at = slice(self.first[t], self.first[t + 1])
            row_[self.docs[at]] = self.impact[at]
        self.most = whole.reshape(len(common), blocks, 1 << BLOCK_BITS).max(2, initial=0.0)
        self.common = whole[:, :self.n]

    def scored(self, queries: list[tuple[np.ndarray, np.ndarray]], least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores by (query, document), 0 for those that don't reach the query's
        ``least``, and for each query the documents whose common terms were all
        looked up."""
        count, least = len(queries), _floor(least)
        q = np.repeat(np.arange(count), [len(t) for t, _ in queries])
        terms, weights = (np.concatenate([x[i] for x in queries]) for i in (0, 1))
        at = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
        here = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        q, at, weights = q[here], at[here], weights[here]
        rows = self.row[at]
        rare = rows < 0
        # common terms by their largest contribution: the first ones of a query stay for later
        cq, rows, w = q[~rare], rows[~rare], weights[~rare]
        peak = w * self.peak[at[~rare]]
        order = np.lexsort((peak, cq))
        cq, rows, w, peak = cq[order], rows[order], w[order], peak[order]
        total = np.cumsum(peak)
        begin = np.searchsorted(cq, np.arange(count))
        total -= np.concatenate([[0.0], total])[begin][cq]
        late = total < (least * SPLIT)[cq]
        now, later = (np.zeros((count, len(self.common))) for _ in range(2))
        now[cq[~late], rows[~late]] = w[~late]
        later[cq[late], rows[late]] = w[late]
        q, at, weights = q[rare], at[rare], weights[rare]
        size = self.first[at + 1] - self.first[at]
        posts = _ranges(self.first[at], size)
        flat = np.bincount(self.docs[posts] + np.repeat(q * self.n, size), self.impact[posts] * np.repeat(weights, size),
                           minlength=count * self.n).reshape(count, self.n)
        scores = flat + now @ self.common
        looked = np.full(count, self.n)
        waits = np.flatnonzero(later.any(1))
        if len(waits):
            bound = np.repeat(later[waits] @ self.most, 1 << BLOCK_BITS, axis=1)[:, :self.n]
            open_ = scores[waits] + bound >= least[waits][:, None]
            for i, may in zip(waits.tolist(), open_):
                docs, use = np.flatnonzero(may), np.flatnonzero(later[i])
                looked[i] = len(docs)
                sums = scores[i, docs] + later[i, use] @ self.common[np.ix_(use, docs)]
                scores[i] = 0
                scores[i, docs] = sums
        scores[scores < least[:, None]] = 0
        return scores, looked


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Documents (by place) with the k best scores over 0, and ties of the last."""
    places = np.flatnonzero(scores)
    if len(places) > k:
        places = places[scores[places] >= np.partition(scores[places], -k)[-k] - _UNIT]
    return places


def _floor(least: np.ndarray) -> np.ndarray:
    """What a score has to reach, with room for rounding."""
    return np.maximum(least * (1 - _SLACK) - _SLACK, 0.0)


def _search_shards(index: DataFrame, sent, mean_words: float, k: int, kinds: tuple[str, str],  # noqa: ANN001
                   least: dict[int, float]) -> DataFrame:
    """qno, query_id, doc_id, score: what the shards of ``index`` have for the queries
    ``sent`` (ids; terms and weights of each) from the score ``least`` on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = sent.value
        bar = np.array([least.get(q, 0.0) for q in range(len(queries))])
        top = np.zeros((len(queries), k))  # the best scores in this task
        hits = []
        for batch in batches:
            ids, rows = batch.column("ids"), batch.drop_columns(["ids"]).to_pylist()
            for i, row in enumerate(rows):
                shard = Shard(row, mean_words)
                own = ids[i].values
                for lo in range(0, len(queries), AT_ONCE):
                    scores = shard.scored(queries[lo:lo + AT_ONCE], bar[lo:lo + AT_ONCE])[0]
                    for q in (np.flatnonzero(scores.any(1)) + lo).tolist():
                        places = _best(scores[q - lo], k)
                        got = np.rint(scores[q - lo, places] / _UNIT) * _UNIT
                        top[q] = np.sort(np.append(top[q], got))[-k:]
                        bar[q] = max(bar[q], top[q, 0])
                        hits.append((q, own.take(pa.array(places)), got))
        for q, docs, scores in hits:
            keep = scores >= _floor(bar[q])
            n = int(keep.sum())
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, q, np.int32)), names.take(pa.array(np.full(n, q))), docs.filter(pa.array(keep)),
                     pa.array(scores[keep])], names=["qno", "query_id", "doc_id", "score"])
    return index.mapInArrow(run, f"qno int, query_id {kinds[0]}, doc_id {kinds[1]}, score double")


def search(index: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), doc_id, score: the k best documents of every
    query (doc_id, text)."""
    spark = index.sparkSession
    kinds = dict(queries.dtypes)["doc_id"], dict(index.dtypes)["ids"][len("array<"):-1]
    n, words, shards = index.agg(F.sum("n"), F.sum("words"), F.count("*")).first()
    n, mean_words = n or 0, (words or 0) / (n or 1) or 1.0
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = (query_terms(queries).join(frequencies(index), "term")
               .groupBy("query_id", "term").agg(F.sum(F.col("qtf") * idf).alias("weight")))
    per_query = written(weighed.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("t")), "queries")
    # queries in blocks of bounded size: one after the other goes over all shards
    sized = per_query.withColumn("_key", F.xxhash64("query_id")).withColumn("_n", F.size("t").cast("long"))
    dealt = written(running_start(sized, [], [F.col("_key"), F.col("query_id")], F.col("_n"), "_start", 64)
                    .select("query_id", "t", F.floor(F.col("_start") / QUERY_TERMS).alias("block")), "blocks")
    # a shard's round: its place among all, by hash, in powers of two of the first round's share
    place = F.shiftrightunsigned(F.xxhash64("terms", "words", "lengths"), 11) / F.lit(float(1 << 53))
    turn = F.greatest(F.lit(0), F.ceil(F.log2(place * F.lit(shards / FIRST_SHARDS)))).cast("int")
    rounds = sorted(r[0] for r in index.select(turn).distinct().collect())  # as many as the log of the shards
    found = None
    for (block,) in sorted(dealt.select("block").distinct().collect()):
        rows = dealt.where(F.col("block") == block).select("query_id", "t.term", "t.weight").toArrow()
        names, terms, weights = (rows.column(c).combine_chunks() for c in range(3))
        sent = spark.sparkContext.broadcast((names, [(t.values.to_numpy().view(np.uint64), w.values.to_numpy())
                                                     for t, w in zip(terms, weights, strict=True)]))
        hits, least = None, {}
        for r in rounds:
            own = _search_shards(index.where(turn == r) if len(rounds) > 1 else index, sent, mean_words, k, kinds, least)
            old, hits = hits, written(_best_of(own if hits is None else hits.drop("rank").unionByName(own), k), "hits")
            if old is not None:
                discard(old)
            if r != rounds[-1]:  # a score per query of the block
                least = {x["qno"]: x["least"] for x in hits.groupBy("qno").agg(F.count("*").alias("n"), F.min("score").alias("least"))
                         .where(F.col("n") >= k).collect()}
        sent.destroy()
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], f"query_id {kinds[0]}, rank int, doc_id {kinds[1]}, score double")
    return found.select("query_id", "rank", "doc_id", "score")


def _best_of(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("qno").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("qno", "query_id", "rank", "doc_id", "score"))


def is_query(doc_id: Column) -> Column:
    return doc_id % 100 == 0


def bm25_digest(docs: DataFrame) -> DataFrame:
    """Top ``K`` of every document whose id is divisible by 100, among all documents."""
    docs = docs.select("doc_id", "text")
    return search(build_index(docs), docs.where(is_query(F.col("doc_id"))))
