"""Connected classes of a similarity join whose candidates come in groups.

Members of a group (a shared n-gram, a shared segment) are candidate partners.
A group may hold a third of all members, so its pairs are never all written
out.  In a round every group names one pivot and compares its other members
with it: as many pairs as members.  Groups that hold the same members name
different pivots, so a set of alike members is compared with many of its own in
one round.  Links join classes, and only pairs between different classes are
still of interest, so large groups of alike members vanish.  Once the pairs left are no more than the members, or a round has
not removed half of them (what is left then aren't alike members), all of them
are compared, each pair in one group only.  The classes are exact: a pair is left out only if its two
members are known to be connected, or were compared before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import small_side, written
from txrisk.session import discard, release

#: Pairs left per member at which the rest is compared at once, and rounds after which it is in any case.
PAIRS_PER_MEMBER, ROUNDS = 1, 8


def components(links: DataFrame) -> DataFrame:
    """id, root of every end of ``links`` (a, b): root is the least id it reaches.

    Each step sends every vertex to its least neighbour and contracts the
    edges; the vertices left shrink by a constant factor, as ids are hashes.
    """
    edges = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "edges")
    moves = []
    while edges.take(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to"))
                       .select("id", F.least("id", "to").alias("to")), "moves")
        moves.append(move)
        to = small_side(move)
        end = lambda c: to.select(F.col("id").alias(c), F.col("to").alias(f"{c}_to"))
        old, edges = edges, written(edges.join(end("a"), "a").join(end("b"), "b").where("a_to <> b_to")
                        .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
                        .distinct(), "edges")
        discard(old)
    if not moves:
        return links.select(F.col("a").alias("id"), F.col("a").alias("root")).where("false")
    out = moves[-1].withColumnRenamed("to", "root")
    for move in reversed(moves[:-1]):
        later = out.withColumnRenamed("id", "to")
        out = written(move.join(small_side(later), "to", "left").select(
            "id", F.coalesce("root", "to").alias("root")), "roots")
    least = out.groupBy("root").agg(F.min("id").alias("least"))
    least = least.select("root", F.least("root", "least").alias("least"))
    return out.join(least, "root").select("id", F.col("least").alias("root"))


def connected(members: DataFrame, may_link: Callable[[Column, Column], Column],
              verify: Callable[[DataFrame], DataFrame], attrs: list[str],
              met_before: Callable[[Column, Column], Column] | None = None,
              rest_of: Callable[[DataFrame], DataFrame] | None = None,
              pivot_by: tuple[str, ...] = ("grp", "id")) -> tuple[DataFrame, DataFrame]:
    """Classes of ``members`` (grp, id, *attrs).

    ``rest_of`` may make the pairs (a, b) of the last round in its own way, from the
    members (grp, id, comp, size of the group, *attrs); it then applies both
    conditions below itself.  Pivots are those of the least hash of ``pivot_by``: of the
    id alone, groups of almost the same members mostly name the same, and make fewer pairs.

    ``may_link`` tells from the attributes (as structs) of two members whether
    they need comparing, ``met_before`` whether they meet in another group that
    comes earlier; ``verify`` keeps the linked ones of pairs (a, b).
    Returns (id, root) of every linked id, and the links found.  ``members`` of
    :func:`written` are read as they are, and removed at the end.
    """
    if not getattr(members, "_txrisk_path", None):
        members = written(members.select("grp", "id", *attrs), "members")
    n = members.count()
    own = F.struct("id", "comp", *attrs)
    labels = tested = links = before = None
    for turn in range(ROUNDS + 1):
        m = members.withColumn("comp", F.col("id"))
        if labels is not None:
            m = members.join(small_side(labels), "id", "left").withColumn("comp", F.coalesce("root", "id")).drop("root")
        # groups of one class are done
        sizes = m.groupBy("grp", "comp").agg(F.count("*").alias("n"))
        left = (sizes.groupBy("grp").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                                         F.count("*").alias("comps")).where("comps > 1"))
        left = written(left.select("grp", F.col("n").alias("size"), ((F.col("n") * F.col("n") - F.col("nn")) / 2).alias("pairs")), "left")
        rest = left.agg(F.sum("pairs")).first()[0] or 0
        if not rest:
            break
        sized = left.select("grp", "size")
        last = turn == ROUNDS or rest <= PAIRS_PER_MEMBER * n or (before is not None and 2 * rest > before)
        before = rest
        m = written(m.join(small_side(sized), "grp"), "members-left")
        if last and rest_of:
            pairs = rest_of(m)
        elif last:
            # pairs of classes of a group, then their members: no pair within a class is made
            side = m.select("grp", "comp").distinct()
            classes = (side.join(side.withColumnRenamed("comp", "comp_b"), "grp").where("comp < comp_b"))
            pairs = (classes.join(m.select("grp", "comp", own.alias("x")), ["grp", "comp"])
                     .join(m.select("grp", F.col("comp").alias("comp_b"), own.alias("y")), ["grp", "comp_b"]))
            if met_before:
                pairs = pairs.where(~met_before(F.col("x"), F.col("y")))
        else:
            pivots = m.groupBy("grp").agg(F.min_by(own, F.struct(F.xxhash64(*pivot_by, F.lit(turn)), "id")).alias("y"))
            pairs = m.select("grp", own.alias("x")).join(pivots, "grp").where("x.comp <> y.comp")
        if "x" in pairs.columns:
            pairs = (pairs.where(may_link(F.col("x"), F.col("y")))
                     .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        found = written(verify(pairs).select("a", "b"), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        old, labels = labels, written(components(links), "labels")
        for done in (left, m, old):
            if done is not None:
                discard(done)
        release(members.sparkSession)
        if last:
            break
    discard(members)
    if labels is None:
        kind = dict(members.dtypes)["id"]
        links = members.sparkSession.createDataFrame([], f"a {kind}, b {kind}")
        labels = links.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return labels, links
