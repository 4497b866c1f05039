"""Odd rows and empty tables: every operator has a defined result for them."""

import pytest
from pyspark.sql import functions as F
from texts import odd_docs  # noqa: F401

from txrisk.llm import (bm25, chat, license_scan, line_dedup, mixing, ngram_join, packing, quality,
                        secret_scan, toxicity)

PER_ROW = {
    "quality": quality.quality_digest, "mix": mixing.mix_digest, "join": ngram_join.component_ids,
    "license": license_scan.license_digest, "secret": secret_scan.secret_digest, "lines": line_dedup.line_digest,
}


def labels_of(spark, docs):
    return docs.select("doc_id", F.lit(1).alias("quality"), (F.coalesce("doc_id", F.lit(0)) % 2).cast("int").alias("toxic"))


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_document(odd_docs, name):
    got = sorted(PER_ROW[name](odd_docs).collect(), key=str)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd_docs.collect())
    twins = [r for r in got if r.doc_id == 1]
    assert len(twins) == 2
    if name != "mix":  # the mix may take rows that repeat a document differently
        assert twins[0] == twins[1]


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(odd_docs, name):
    got = PER_ROW[name](odd_docs.where("false"))
    assert got.collect() == []


def test_toxicity_edges(spark, odd_docs):
    got = toxicity.toxicity(odd_docs, labels_of(spark, odd_docs)).collect()
    assert len(got) == odd_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    none = toxicity.toxicity(odd_docs, labels_of(spark, odd_docs).where("false")).collect()
    assert len(none) == len(got) and max(r.score for r in none) < 1e-9
    assert toxicity.toxicity(odd_docs.where("false"), labels_of(spark, odd_docs)).collect() == []


def test_packing_edges(odd_docs):
    got = packing.packed(odd_docs).collect()
    assert sum(r.piece == 0 for r in got) == odd_docs.count()
    empty = [r for r in got if r.doc_id in (3, 4)]
    assert [(r.length, r.start) for r in empty] == [(1, 0), (1, 0)]
    assert packing.packed(odd_docs.where("false")).collect() == []


def test_search_edges(odd_docs):
    got = bm25.bm25_digest(odd_docs).collect()
    assert {r.query_id for r in got} == {100, 200, 300}
    assert {r.doc_id for r in got if r.query_id == 100} >= {1, 2, 100, None}
    assert bm25.bm25_digest(odd_docs.where("false")).collect() == []


def test_keeping_columns(odd_docs):
    for keep in (quality.keep_good, line_dedup.keep_new_lines, ngram_join.keep_one, mixing.mixed_documents):
        got = keep(odd_docs)
        assert got.columns == odd_docs.columns and got.dtypes == odd_docs.dtypes
        assert got.count() > 0
        assert keep(odd_docs.where("false")).count() == 0


def test_chat_edges(spark):
    turns = spark.createDataFrame(
        [(1, 1, "user", None, "x"), (1, 0, None, "a\\<|im_end|>\n<", "x"), (None, None, "assistant", "", "x"),
         (2, 0, "as\nsistant", "<", "x"), (2, 0, "as\nsistant", "<", "x")],
        "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.chat_digest(turns).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 2, None: 1, 2: 2, -1: 2}
    assert got[None].loss_chars == 0
    assert [r.conv_id for r in chat.chat_digest(turns.where("false")).collect()] == [-1]


def test_columns_named_like_helpers_are_kept(odd_docs):
    taken = ["_id", "_hash", "_gone", "_source", "_size", "_copies", "_copy", "_id_1", "n_removed", "items"]
    docs = odd_docs.select("*", *[F.lit(c).alias(c) for c in taken])
    for keep in (quality.keep_good, line_dedup.keep_new_lines, ngram_join.keep_one, mixing.mixed_documents):
        got, plain = keep(docs), keep(odd_docs)
        assert got.dtypes == docs.dtypes
        assert {tuple(r) for r in got.select(*taken).distinct().collect()} == {tuple(taken)}
        assert sorted(map(str, got.drop(*taken).collect())) == sorted(map(str, plain.collect()))
    assert packing.packed(docs).count() == packing.packed(odd_docs).count()
