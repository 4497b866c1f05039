"""Trie of the prefixes that rebuilt conversations share.

A conversation ``c`` is rebuilt from the first ``h`` turns of conversation
``c - c % 100`` and its own turns after its first ``h``, where ``h`` is the unsigned
crc32 of the decimal ``c`` modulo 6.  A node is a distinct sequence of first turns;
its members are the rebuilt conversations that begin with it.

Texts stay where they are read: from there on a turn is its md5 and its number of
characters, and a prefix is two xors of 64-bit hashes of (place, md5).  A count-min
sketch of all prefix digests (two rows of saturating counters, one per xor) is
merged and broadcast.  An estimate of one proves that a prefix has one member: its
node is made where the row is, without a shuffle.  Only prefixes that may be shared
are grouped by digest, exactly, so a false alarm costs a row of shuffle and never
a wrong number.  A node passes what it saves, its leaves and its first member's
place to the nodes above it through that member's rows, as sums from the deepest
turn up, so no subtree is ever collected.

The sketch has ``CELLS_PER_PREFIX`` counters a prefix, at most 2**``MAX_BITS`` a row
(16 MB of broadcast); beyond that more prefixes are grouped, with the same result.

Defined results: a null role or text is ''; turns go by ``turn`` (null first), equal
ones by the md5 of role and text, repeated rows are turns of their own; rows of a
null conv_id belong to no conversation; an empty table has no node, not even a
root.  Equality of prefixes is equality of 128 bits of hash.  The list of ends of a
node is hashed as a stream, in pieces that many tasks prepare, as SHA-256 has to
see it in one order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import written
from txrisk.llm.textnum import mix
from txrisk.session import discard

HEAD_MODULUS = 6
ANCHOR_EVERY = 100
CELLS_PER_PREFIX = 8
MIN_BITS, MAX_BITS = 16, 26
SEGMENT = 1 << 15  # cells of a row of the table that merges the sketch
_NO_END = hashlib.sha256(b"").hexdigest()


def head_turns(conv: Column) -> Column:
    """``h``: how many turns come from the anchor conversation."""
    return F.crc32(conv.cast("string").cast("binary")) % HEAD_MODULUS


def anchor(conv: Column) -> Column:
    return conv - conv % ANCHOR_EVERY


def _numbered(conversations: DataFrame) -> DataFrame:
    """(conv, pos, md, chars, h): the turns in order, from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    md = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", md.alias("md"), F.char_length(text).alias("chars"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "md")
    return turns.select("conv", F.row_number().over(order).alias("pos"), "md", "chars", head_turns(F.col("conv")).alias("h"))


def rebuilt_prefixes(conversations: DataFrame) -> DataFrame:
    """(conv, depth, last, g1, g2, p1, p2, chars): each prefix of each rebuilt
    conversation, the root included, with its digest, that of the prefix before it,
    the depth of the whole conversation and the characters of its last text."""
    turns = written(_numbered(conversations), "turns")
    convs = turns.where("pos = 1").select("conv", "h", anchor(F.col("conv")).alias("anchor"))
    heads = (turns.where((F.col("pos") < HEAD_MODULUS) & (F.col("conv") == anchor(F.col("conv"))))
             .select(F.col("conv").alias("anchor"), "pos", "md", "chars"))
    root = convs.select("conv", F.lit(0).alias("part"), F.lit(0).alias("pos"), F.lit("").alias("md"), F.lit(0).alias("chars"))
    taken = convs.where("h > 0").join(heads, "anchor").where("pos <= h").select("conv", F.lit(1).alias("part"), "pos", "md", "chars")
    own = turns.where("pos > h").select("conv", F.lit(2).alias("part"), "pos", "md", "chars")
    by_conv = Window.partitionBy("conv").orderBy("part", "pos")
    so_far = by_conv.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (root.unionByName(taken).unionByName(own)
            .withColumn("depth", F.row_number().over(by_conv) - 1)
            .withColumn("last", F.count(F.lit(1)).over(Window.partitionBy("conv")) - 1))
    for i in (1, 2):
        rows = (rows.withColumn(f"e{i}", F.when(F.col("depth") > 0, F.xxhash64(F.lit(i), "depth", "md")).otherwise(F.lit(0)))
                .withColumn(f"g{i}", F.bit_xor(f"e{i}").over(so_far)))
    return rows.select("conv", F.col("depth").cast("int").alias("depth"), F.col("last").cast("int").alias("last"), "g1", "g2",
                       F.col("g1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("g2").bitwiseXOR(F.col("e2")).alias("p2"), "chars")


def _cells(column: pa.Array, bits: int) -> np.ndarray:
    return (mix(column.to_numpy().view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(bits: int):
    """A partition's counters (none, one, two or more) as bitmaps by segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.uint8)
        for batch in batches:
            for row, column in zip(counts, batch.columns):
                cells, n = np.unique(_cells(column, bits), return_counts=True)
                row[cells] = np.minimum(row[cells] + np.minimum(n, 2), 2)
        parts = counts.reshape(-1, SEGMENT)
        for i in np.flatnonzero(parts.any(1)):
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array([i], pa.int32()),
                "once": [np.packbits(parts[i] > 0).tobytes()], "again": [np.packbits(parts[i] > 1).tobytes()]})
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of all partitions, by segment; what is known to be two or more."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for segment, *maps in zip(*[c.to_pylist() for c in batch.columns]):
            once, again = (np.frombuffer(m, np.uint8) for m in maps)
            if segment in held:
                once0, again0 = held[segment]
                once, again = once0 | once, again0 | again | (once0 & once)
            held[segment] = once, again
    for segment, (_, again) in held.items():
        if again.any():
            yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "again": [again.tobytes()]})


def shared_cells(prefixes: DataFrame) -> tuple[np.ndarray, int]:
    """The cells whose counter is over one, as two bitmaps, and the bits of a cell."""
    n = prefixes.count()
    bits = min(max((CELLS_PER_PREFIX * max(n, 1) - 1).bit_length(), MIN_BITS), MAX_BITS)
    merged = (prefixes.select("g1", "g2").mapInArrow(_sketch(bits), "segment int, once binary, again binary")
              .repartition("segment").mapInArrow(_merge, "segment int, again binary"))
    bitmap = np.zeros(((2 << bits) // SEGMENT, SEGMENT // 8), np.uint8)
    for row in merged.toLocalIterator():  # at most the bitmap's own size
        bitmap[row["segment"]] = np.frombuffer(row["again"], np.uint8)
    return bitmap.reshape(2, -1), bits


def _screen(prefixes: DataFrame) -> DataFrame:
    """``prefixes`` with ``maybe`` and ``p_maybe``: may the prefix, and the one before
    it, be shared?"""
    bitmap, bits = shared_cells(prefixes)
    known = prefixes.sparkSession.sparkContext.broadcast(bitmap)

    def hit(row: np.ndarray, column: pa.Array) -> np.ndarray:
        cell = _cells(column, bits)
        return (row[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = known.value
        for batch in batches:
            flags = [pa.array(hit(one, batch.column(a)) & hit(two, batch.column(b))) for a, b in (("g1", "g2"), ("p1", "p2"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], [*batch.schema.names, "maybe", "p_maybe"])

    schema = ", ".join(f"{c} {t}" for c, t in prefixes.dtypes)
    return prefixes.mapInArrow(run, f"{schema}, maybe boolean, p_maybe boolean")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (g1, g2, conv) as one row per run of equal digests: its first conv and
    all of them as text."""
    for batch in batches:
        g1, g2, conv = (c.to_numpy() for c in batch.columns)
        at = np.flatnonzero(np.append(True, (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1]))) if len(g1) else np.zeros(0, int)
        texts = [",".join(map(str, ids.tolist())) for ids in np.split(conv, at[1:])] if len(at) else []
        yield pa.RecordBatch.from_pydict({"g1": g1[at], "g2": g2[at], "conv": conv[at], "ids": pa.array(texts, pa.string())})


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each digest, comma-joined, as a stream."""
    key, state = None, None
    def done():
        return pa.RecordBatch.from_pydict({"g1": pa.array([key[0]], pa.int64()), "g2": pa.array([key[1]], pa.int64()),
                                           "ends_sha256": [state.hexdigest()]})
    for batch in batches:
        for g1, g2, ids in zip(*[batch.column(c).to_pylist() for c in ("g1", "g2", "ids")]):
            if key == (g1, g2):
                state.update(b"," + ids.encode())
            else:
                if key is not None:
                    yield done()
                key, state = (g1, g2), hashlib.sha256(ids.encode())
    if key is not None:
        yield done()


def _ends(maybe: DataFrame) -> DataFrame:
    """(g1, g2, ends_sha256) of the nodes where conversations end."""
    key = ["g1", "g2", "conv"]
    pieces = (maybe.where("depth = last").select(*key).repartitionByRange(*key).sortWithinPartitions(*key)
              .mapInArrow(_pieces, "g1 long, g2 long, conv long, ids string"))
    return (pieces.repartition("g1", "g2").sortWithinPartitions(*key)
            .mapInArrow(_hash_pieces, "g1 long, g2 long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prefixes = written(rebuilt_prefixes(conversations), "prefixes")
    rows = written(_screen(prefixes), "screened-prefixes")
    discard(prefixes)
    maybe, single = rows.where("maybe"), rows.where("NOT maybe")

    # what each node gives to the nodes above it, at the place of its smallest member
    nodes = maybe.groupBy("g1", "g2", "depth").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.max("chars").alias("chars"),
        F.count_if(F.col("depth") == F.col("last")).alias("ends"))
    none = F.lit(0).cast("long")
    gives = nodes.select("conv", "depth", ((F.col("n") - 1) * F.col("chars")).alias("saves"), F.lit(1).alias("node"),
                         (F.col("ends") == F.col("n")).cast("int").alias("leaf"))
    tails = single.where("p_maybe OR depth = last").select(
        "conv", "depth", none.alias("saves"), F.lit(1).alias("node"), (F.col("depth") == F.col("last")).cast("int").alias("leaf"))
    kept = ["last", "g1", "g2", "p1", "p2"]
    places = (maybe.select("conv", "depth", none.alias("saves"), F.lit(0).alias("node"), F.lit(0).alias("leaf"), *kept)
              .unionByName(gives.unionByName(tails), allowMissingColumns=True))
    upward = Window.partitionBy("conv").orderBy(F.desc("depth"))
    below = upward.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    places = places.select(
        "conv", "depth", *kept, F.sum("saves").over(below).alias("saves"), F.sum("leaf").over(below).alias("leaves"),
        F.coalesce(F.sum("node").over(upward.rangeBetween(-1, -1)), none).alias("children")).where(F.col("g1").isNotNull())
    shared = written(places.groupBy("g1", "g2", "depth").agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("children").alias("n_children"),
        F.sum("leaves").alias("n_leaves"), F.sum("saves").alias("saved_tokens"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2")), "shared-prefixes")
    shared_out = (shared.join(_ends(maybe), ["g1", "g2"], "left")
                  .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_END))))

    ends_here = F.col("depth") == F.col("last")
    alone = single.select(
        F.col("conv").alias("conv_id"), "depth", "p1", "p2", "p_maybe", F.lit(1).alias("n_convs"),
        F.when(ends_here, 0).otherwise(1).alias("n_children"), F.lit(1).alias("n_leaves"), none.alias("saved_tokens"),
        F.when(ends_here, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(_NO_END)).alias("ends_sha256"))
    inside = alone.where("NOT p_maybe AND depth > 0").withColumn("parent_conv_id", F.col("conv_id"))
    asks = shared_out.drop("g1", "g2").unionByName(alone.where("p_maybe OR depth = 0").drop("p_maybe"))
    first = maybe.agg(F.min("conv")).scalar()
    top = asks.where("depth < 2").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.coalesce(first, F.col("conv_id"))))
    parents = shared.select(F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("depth") + 1, F.col("conv_id").alias("parent"))
    parents = parents.toDF("p1", "p2", "depth", "parent")
    deeper = (asks.where("depth > 1").join(parents, ["p1", "p2", "depth"], "left")
              .withColumn("parent_conv_id", F.coalesce("parent", "conv_id")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    parts = [df.select(*[F.col(c).cast("long").alias(c) for c in columns], "ends_sha256") for df in (inside, top, deeper)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
