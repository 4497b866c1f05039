"""License scans (operator 5).

Every text's rolling word 3-gram hashes are joined to the positions of these
hashes in a fixed table of license templates.  A hit votes for its diagonal
(position in the text minus position in the template).  Diagonals at most
``DRIFT`` apart whose hits lie near each other merge, which bridges words
inserted or left out, and a merged span is verified by the share of the
template's words that it covers.  A word put in next to an end of a short statement
leaves less than three words there; texts with a hit of such a statement are read
again for its pairs of words and its first and last word, which complete a span
that they lie in or next to.  Where merged short statements begin or end at one
word, the longest holds, besides those that are whole on one diagonal.

Phrases of the base rule must be covered whole, on one diagonal.  The templates
are the only broadcast table: fixed text, a few hundred positions.

Defined results: null and empty texts have no words and no labels; repeated
rows get equal rows; an empty table gives no rows; other columns are not read.
Equality of 3-grams is that of 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.llm.common import small_side, written

K = 3
DRIFT = 3
#: Words of a template between two hits of one span, at most.
REACH = 24
#: Of every so many words of a statement, so many may be missing; a shorter one must have all of its words.
PER_WORDS, MAY_MISS = 12, 2

# Phrases of the base rule and their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Statements by which the method adds labels.
STATEMENTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation "
              "either version 3 of the license"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted "
              "provided that the following conditions are met"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("all-rights-reserved", "copyright all rights reserved"),
]
# The bytes that part words are ASCII without letters and digits.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, NOT_WORD, -1), "")


def rolling(ws: Column) -> Column:
    """Hash of the K words from each position on (null past the end)."""
    # zipped with its own tails, so no step looks up words by position
    tails = [F.slice(ws, j + 1, F.greatest(F.size(ws) - j, F.lit(0))).alias(f"w{j}") for j in range(K)]
    return F.transform(F.arrays_zip(*tails), lambda z: F.when(
        z[f"w{K - 1}"].isNotNull(), F.xxhash64(*[z[f"w{j}"] for j in range(K)])))


def templates(spark: SparkSession) -> DataFrame:
    """template, label, base, n_template, at, gram: the templates' positions."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(i < len(PHRASES)).alias("base"),
                 F.lit(text).alias("text"))
        for i, (label, text) in enumerate([*PHRASES, *STATEMENTS])])
    return (spark.range(1).select(F.explode(rows).alias("t")).select("t.*", words(F.col("t.text")).alias("ws"))
            .select("template", "label", "base", F.size("ws").alias("n_template"),
                    F.posexplode_outer(rolling(F.col("ws"))).alias("at", "gram")).where("gram is not null"))


def fragments(spark: SparkSession) -> DataFrame:
    """template, at, size, fragment: pairs of words of short statements, and their ends."""
    rows = []
    for i, (_, text) in enumerate(STATEMENTS, len(PHRASES)):
        ws = text.split(" ")
        if len(ws) < PER_WORDS:
            rows += [(i, at, 2, " ".join(ws[at:at + 2])) for at in range(len(ws) - 1)]
            rows += [(i, 0, 1, ws[0]), (i, len(ws) - 1, 1, ws[-1])]
    cells = F.array(*[F.struct(F.lit(t).alias("template"), F.lit(at).alias("at"), F.lit(k).alias("size"), F.lit(f).alias("fragment"))
                      for t, at, k, f in rows])
    return spark.range(1).select(F.explode(cells).alias("f")).select("f.*")


def _completed(docs: DataFrame, merged: DataFrame) -> DataFrame:
    """``merged`` with the fragments that lie in or next to spans of short statements."""
    doc = ["doc_id", "text_hash"]
    open_ = merged.where(~F.col("base") & (F.col("n_template") < PER_WORDS) & ~F.col("whole"))
    few = small_side(written(open_.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "short-statements"))
    text_hash = F.xxhash64("text")
    read = (docs.join(few, F.col("doc_id").eqNullSafe(F.col("_id")) & (text_hash == F.col("_hash")), "left_semi")
            .select("doc_id", text_hash.alias("text_hash"), words(F.col("text")).alias("ws")).distinct())
    pair = F.transform(F.arrays_zip(F.col("ws").alias("w"), F.slice("ws", 2, F.size("ws")).alias("v")),
                       lambda z: F.array(z["w"], F.concat_ws(" ", z["w"], z["v"])))
    seen = (read.select(*doc, F.posexplode(pair).alias("pos", "said")).select(*doc, "pos", F.explode(F.array_distinct("said")).alias("fragment"))
            .join(F.broadcast(fragments(docs.sparkSession)), "fragment").select(*doc, "template", "pos", "at", "size"))
    s, f = merged.alias("s"), seen.alias("f")
    near = (F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("s.text_hash") == F.col("f.text_hash"))
            & (F.col("s.template") == F.col("f.template")) & ~F.col("s.whole")
            & (F.col("f.pos") - F.col("f.at")).between(F.col("s.least") - DRIFT, F.col("s.most") + DRIFT)
            & (F.col("f.pos") + F.col("f.size") + DRIFT >= F.col("s.first_word")) & (F.col("f.pos") <= F.col("s.last_word") + 1 + DRIFT))
    found = (s.join(f, near).groupBy(*[F.col(f"s.{c}") for c in (*doc, "template", "span")])
             .agg(F.min("f.pos").alias("begins"), F.max(F.col("f.pos") + F.col("f.size") - 1).alias("ends"),
                  F.flatten(F.collect_set(F.sequence("f.at", F.col("f.at") + F.col("f.size") - 1))).alias("more")))
    m, g = merged.alias("m"), found.alias("g")
    same = (F.col("m.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("m.text_hash") == F.col("g.text_hash"))
            & (F.col("m.template") == F.col("g.template")) & (F.col("m.span") == F.col("g.span")))
    kept = [F.col(f"m.{c}") for c in merged.columns if c not in ("first_word", "last_word", "words")]
    return m.join(g, same, "left").select(
        *kept, F.least("m.first_word", "g.begins").alias("first_word"), F.greatest("m.last_word", "g.ends").alias("last_word"),
        F.array_distinct(F.concat("m.words", F.coalesce("g.more", F.array().cast("array<int>")))).alias("words"))


def spans(docs: DataFrame) -> DataFrame:
    """Verified spans of ``docs`` (doc_id, text): doc_id, text_hash, template,
    label, base, first_word, last_word (of the span), score (share covered)."""
    t = F.broadcast(templates(docs.sparkSession))
    grams = (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("ws"))
             .withColumn("grams", rolling(F.col("ws")))
             # outer: an inner explode adds a filter that computes the hashes twice
             .select("doc_id", "text_hash", F.posexplode_outer("grams").alias("pos", "gram")))
    hits = (grams.join(t, "gram").withColumn("diagonal", F.col("pos") - F.col("at"))
            # repeated rows of a document vote once; a 3-gram that a template has twice votes for both places
            .select("doc_id", "text_hash", "template", "label", "base", "n_template", "diagonal", "pos", "at")
            .distinct())
    group = ["doc_id", "text_hash", "template", "label", "base", "n_template"]
    # votes by diagonal: runs of hits that are at most REACH words apart
    line = Window.partitionBy(*group, "diagonal").orderBy("pos")
    run = F.sum(F.when(F.col("pos") - F.lag("pos").over(line) <= REACH, 0).otherwise(1)).over(line)
    votes = (hits.withColumn("run", run).groupBy(*group, "diagonal", "run")
             .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("at").alias("ats")))
    # neighbours: a new span begins where neither the diagonal nor the place is near an earlier vote's
    by_place = Window.partitionBy(*group).orderBy("lo", "diagonal")
    earlier = by_place.rowsBetween(Window.unboundedPreceding, -1)
    near = ((F.col("lo") - F.max("hi").over(earlier) <= REACH)
            & (F.abs(F.col("diagonal") - F.lag("diagonal").over(by_place)) <= DRIFT)
            & ~F.col("base"))
    merged = (votes.withColumn("span", F.sum(F.when(near, 0).otherwise(1)).over(by_place))
              .groupBy(*group, "span")
              .agg(F.min("lo").alias("first_word"), (F.max("hi") + K - 1).alias("last_word"),
                   F.max(F.size("ats") == F.col("n_template") - K + 1).alias("whole"),
                   F.min("diagonal").alias("least"), F.max("diagonal").alias("most"),
                   F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"))
              .withColumn("words", F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + K - 1))))))
    merged = _completed(docs, written(merged.drop("ats"), "license-spans"))
    covered = F.size("words")
    found = (merged.withColumn("score", covered / F.col("n_template"))
             .where(covered >= F.col("n_template") - F.when(F.col("base"), 0).otherwise(
                 F.expr(f"n_template div {PER_WORDS}") * MAY_MISS)))
    # a word put into one short statement may make another of it (gnu lesser general): the longer one holds there
    short = ~F.col("base") & (F.col("n_template") < PER_WORDS)
    longest = lambda place: F.max(F.when(short, F.col("n_template"))).over(
        Window.partitionBy("doc_id", "text_hash", place))
    found = found.withColumns({"longest_there": F.greatest(longest("first_word"), longest("last_word"))})
    return (found.where(~short | F.col("whole") | (F.col("n_template") >= F.col("longest_there")))
            .drop("span", "least", "most", "words", "n_template", "whole", "longest_there"))


def license_digest(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    base = lambda c: F.when(F.col("base"), c)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = (spans(docs).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
             .agg(F.count(base(F.lit(1))).alias("n_base"),
                  F.min(base(F.col("first_word"))).cast("long").alias("first_word"),
                  F.max(base(F.col("first_word"))).cast("long").alias("last_word"),
                  joined(base(F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
                  F.max("score").alias("score")))
    n = F.coalesce(F.regexp_count("text", F.lit(ANY_CASE)), F.lit(0)).cast("long")
    every = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), n.alias("n_words"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return every.join(found, on, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
