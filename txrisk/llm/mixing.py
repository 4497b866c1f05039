"""Mixing sources to target weights (operator 2).

Targets: the sources share ``share`` times all words by weight; none gets more
than ``most`` times its own words, what is over goes to the others by weight.

Schedule: slot ``k`` of a mix takes the point of the van der Corput sequence at
``k`` (the bits of k, mirrored), mapped through the sources' cumulated targets.
Slots are ranked within their source.  A source's documents lie in shuffled
order (by md5 of id and seed) on a line of words cut into blocks of
``block_words``; the r-th slot of the source takes its r-th block, and begins
again at the line's start when it ends.  Slot and document meet in a join on
(source, block).  A source stops at its target; where the sequence gave it a
few slots less than that takes, they follow at the schedule's end.

Sources are numbered once (a table with a row a source); all other steps deal
rows by (source, block) or (source, hash bucket), so a source with a third of
all rows is spread like any other.

Defined results: null and empty texts have size 0 and are never taken; the null
source is a source of its own, last in order; a null id shuffles as ''; repeated
rows are documents of their own, and rows that agree in id, source and size come
equally often (their mean, rounded); an empty table gives an empty mix; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import WORD, free_name, running_start, small_side, written

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 256
SEED = "mix-1"
_HASH_BITS = 60
_POINT_BITS = 40
_CELLS = 4096
_RANK_BITS = 14


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: int = 2,
                   weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """src (number), source, source_size, target: one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("src") % len(weights)) + 1).cast("int"))
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("src", (F.row_number().over(by_name) - 1).cast("long"))
         .withColumn("w", weight).withColumn("cap", F.col("source_size") * float(most)))
    # in order of cap by weight, those whose cap is below an equal share stop there
    by_fill = Window.orderBy(F.col("cap") / F.col("w"), "src")
    every = Window.partitionBy()
    s = (s.withColumn("want", F.sum("source_size").over(every) * F.lit(share))
         .withColumn("left", F.col("want") - (F.sum("cap").over(by_fill) - F.col("cap")))
         .withColumn("w_left", F.sum("w").over(every) - (F.sum("w").over(by_fill) - F.col("w")))
         .withColumn("full", F.col("cap") * F.col("w_left") <= F.col("left") * F.col("w")))
    rest = F.col("want") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0))
    w_rest = F.sum(F.when(~F.col("full"), F.col("w"))).over(every)
    return s.select("src", "source", "source_size",
                    F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * rest / w_rest).alias("target"))


def van_der_corput(k: Column) -> Column:
    """The bits of k mirrored at the point: in [0, 1)."""
    mirrored = F.conv(F.reverse(F.lpad(F.bin(k), _POINT_BITS, "0")), 2, 10).cast("long")
    return mirrored / F.lit(float(2**_POINT_BITS))


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, src, rank: what each slot of the mix takes."""
    spark = targets.sparkSession
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    n_slots = int(-(-total // block_words))
    line = Window.orderBy("src")
    # each source's stretch of [0, 1), cut where the cells of an equi-join end
    hi = F.sum("target").over(line) / F.lit(total or 1.0)
    stretch = (targets.where("target > 0").withColumn("hi", hi)
               .withColumn("lo", F.coalesce(F.lag("hi").over(line), F.lit(0.0)))
               .withColumn("hi", F.when(F.row_number().over(Window.orderBy(F.desc("src"))) == 1, 2.0)
                           .otherwise(F.col("hi")))
               .select("src", "lo", "hi", F.explode(F.sequence(
                   F.floor(F.col("lo") * _CELLS),
                   F.least(F.floor(F.col("hi") * _CELLS), F.lit(_CELLS - 1)))).alias("cell")))
    points = (spark.range(n_slots).select(F.col("id").alias("slot"), van_der_corput(F.col("id")).alias("u"))
              .withColumn("cell", F.floor(F.col("u") * _CELLS)))
    slots = (points.join(small_side(stretch), "cell").where("u >= lo and u < hi")
             .select("slot", "src", F.shiftright("slot", _RANK_BITS).alias("run")))
    # rank within the source: by runs of slots, then within the run
    before = Window.partitionBy("src").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (slots.groupBy("src", "run").agg(F.count("*").alias("n"))
            .withColumn("n", F.coalesce(F.sum("n").over(before), F.lit(0))))
    within = Window.partitionBy("src", "run").orderBy("slot")
    ranked = (slots.withColumn("rank", F.row_number().over(within) - 1)
              .join(runs, ["src", "run"])
              .select("slot", "src", (F.col("rank") + F.col("n")).alias("rank")))
    quota = targets.select("src", _slots_needed(block_words).alias("quota"))
    ranked = ranked.join(small_side(quota), "src").where("rank < quota").drop("quota")
    had = slots.groupBy("src").agg(F.count("*").alias("had"))
    late = (quota.join(had, "src", "left").fillna(0, ["had"]).where("had < quota")
            .select("src", F.explode(F.sequence("had", F.col("quota") - 1)).alias("rank"))
            # a few slots a source, as the sequence is even
            .select((F.row_number().over(Window.orderBy("rank", "src")) + (n_slots - 1)).cast("long").alias("slot"),
                    "src", "rank"))
    return ranked.unionByName(late)


def _words_taken() -> Column:
    return F.floor("target").cast("long")


def _slots_needed(block_words: int) -> Column:
    """Blocks of whole passes over the source, then those of what is left."""
    ceil = lambda x: F.expr(f"({x} + {block_words - 1}) div {block_words}")
    return F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")
                  * ceil("source_size") + ceil("cast(floor(target) as bigint) % source_size")) \
        .otherwise(F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size of every document: a written table of narrow rows."""
    return written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")


def mix(sizes: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS,
        block_words: int = BLOCK_WORDS, seed: str = SEED) -> DataFrame:
    """The mix of the documents in ``sizes`` (doc_id, source, size).

    One row per (document, slot that takes words of it): slot, from_word,
    to_word (of the document); a document that is never taken has one row with
    a null slot.  Every row has src, start (of the document on its source's
    line; with src the identity of a document that has words), doc_id, source,
    size, source_size, target.
    """
    targets = written(source_targets(sizes, share, most, weights), "targets")
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit("")))), 1, _HASH_BITS // 4), 16, 10).cast("long")
    t = small_side(targets.withColumnRenamed("source", "_source"))
    docs = (sizes.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("_key", key))
    docs = running_start(docs, ["src"], [F.col("_key"), F.col("doc_id"), F.col("size")],
                         F.col("size"), "start", _HASH_BITS).drop("_key")
    b = F.lit(block_words)
    last = F.expr(f"(start + size - 1) div {block_words}")
    blocks = F.when(F.col("size") > 0, F.sequence(F.expr(f"start div {block_words}"), last))
    pieces = (docs.withColumn("block", F.explode_outer(blocks))
              .withColumn("lo", F.greatest("start", F.col("block") * b))
              .withColumn("hi", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b)))
    n_blocks = F.expr(f"(source_size + {block_words - 1}) div {block_words}")
    slots = (schedule(targets, block_words).join(small_side(targets.drop("source")), "src")
             .select("slot", F.col("src").alias("_src"), (F.col("rank") % n_blocks).alias("_block"),
                     # in the last pass the source ends where its target is reached
                     F.when(F.floor(F.col("rank") / n_blocks) < F.floor(_words_taken() / F.col("source_size")),
                            F.col("source_size"))
                     .otherwise(_words_taken() % F.col("source_size")).alias("_end")))
    on = (F.col("src") == F.col("_src")) & (F.col("block") == F.col("_block")) & (F.col("lo") < F.col("_end"))
    return pieces.join(slots, on, "left").select(
        "slot", "src", "start", "doc_id", "source", "size", "source_size", "target",
        (F.col("lo") - F.col("start")).alias("from_word"),
        (F.least("hi", "_end") - F.col("start")).alias("to_word"))


def taken(mixed: DataFrame) -> DataFrame:
    """Words taken of every document."""
    words = F.when(F.col("slot").isNotNull(), F.col("to_word") - F.col("from_word")).otherwise(F.lit(0))
    mixed = mixed.withColumn("_words", words)
    with_words = (mixed.where("size > 0")
                  .groupBy("src", "start", "doc_id", "source", "size", "source_size", "target")
                  .agg(F.sum("_words").cast("long").alias("taken")))
    empty = mixed.where("size = 0").select("src", "start", "doc_id", "source", "size", "source_size",
                                           "target", F.lit(0).cast("long").alias("taken"))
    return with_words.unionByName(empty)


def mix_digest(docs: DataFrame) -> DataFrame:
    return taken(mix(sized(docs))).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix has them: a document comes as often as the mix takes
    its words, to the nearest whole number (0, 1 or 2 times)."""
    t = taken(mix(sized(docs)))
    id_, source_, size_, copies, copy_ = (free_name(docs, c) for c in ("_id", "_source", "_size", "_copies", "_copy"))
    per_row = (t.groupBy("doc_id", "source", "size")
               .agg((F.sum("taken") / F.count("*")).alias("taken"))
               .where("size > 0")
               .select(F.col("doc_id").alias(id_), F.col("source").alias(source_), F.col("size").alias(size_),
                       F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias(copies))
               .where(F.col(copies) > 0))
    on = (F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("source").eqNullSafe(F.col(source_))
          & (n_words(F.col("text")) == F.col(size_)))
    return (docs.join(per_row, on)
            .withColumn(copy_, F.explode_outer(F.sequence(F.lit(1), F.col(copies))))
            .select(*[docs[c] for c in docs.columns]))
