"""Secret scans (operator 6).

Candidates of several kinds are found in whole texts by pattern.  The hashes of
their values are then counted over the corpus by distinct owner (source) and
repository (source and language): a value that ``EXAMPLE_OWNERS`` or more
owners have is a copied example, and so is one that two owners have in
``EXAMPLE_REPOS`` or more repositories; any other is specific to its owners and
looks live, in however many repositories one owner repeats it.  Candidates of the base kinds are always spans; those of the added kinds
are spans only where they look live.

Defined results: null and empty texts have none; repeated rows get equal rows
and count once; a null source or language is an owner or repository of its own;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import small_side, written

EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 6

# Kind, pattern, group of the value, its least length.  The first three are the base, in order.
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    ("prefixed", r"(?:ghp|gho|ghs|github_pat|sk_live|rk_live|xoxb|xoxp|glpat)[_-][A-Za-z0-9_-]+", 0, 20),
    ("bearer", r"Bearer\x20([A-Za-z0-9._~+/-]+=*)", 1, 20),
]
BASE = ("assign", "access", "hex")
#: A quick test that holds for every text with a span of the kind.
_QUICK = {"access": "AKIA", "jwt": "eyJ", "bearer": "Bearer "}


def _pieces(text: Column, i: int) -> Column:
    """For each match of kind ``i``: its number, the characters between it and
    the match before, and the match.  Scans a text only where the kind occurs."""
    kind, pattern, _, least = KINDS[i]
    if kind == "hex":  # a run is matched whole, so short ones may be passed over at once
        pattern = r"[0-9a-f]{%d,}" % least
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    cut = F.transform(hits, lambda h, k: F.struct(
        F.lit(i).alias("kind"), k.alias("k"), F.char_length(F.get(gaps, k)).alias("gap"), h.alias("hit")))
    occurs = F.contains(text, F.lit(_QUICK[kind])) if kind in _QUICK else F.rlike(text, F.lit(pattern))
    return F.when(occurs, cut).otherwise(F.array().cast(
        "array<struct<kind:int,k:int,gap:int,hit:string>>"))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, kind (number in KINDS), start, end, value_hash, owner,
    repo: one row per candidate span; repeated rows of a document once."""
    text = F.col("text")
    found = (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("source").alias("owner"),
                         F.struct("source", "lang").alias("repo"),
                         # outer: an inner explode adds a filter that scans the texts twice
                         F.explode_outer(F.concat(*[_pieces(text, i) for i in range(len(KINDS))])).alias("c"))
             .where("c is not null")
             .select("doc_id", "text_hash", "owner", "repo", "c.kind", "c.k", "c.gap", "c.hit"))
    found = found.dropDuplicates(["doc_id", "text_hash", "owner", "repo", "kind", "k"])
    line = Window.partitionBy("doc_id", "text_hash", "owner", "repo", "kind").orderBy("k")
    value, least = F.col("hit"), F.lit(0)
    for i, (_, pattern, group, n) in enumerate(KINDS):
        if group:
            value = F.when(F.col("kind") == i, F.regexp_extract("hit", pattern, group)).otherwise(value)
        least = F.when(F.col("kind") == i, n).otherwise(least)
    return (found.withColumn("end", F.sum(F.col("gap") + F.char_length("hit")).over(line).cast("long"))
            .withColumn("start", F.col("end") - F.char_length("hit"))
            .withColumn("value", value).where(F.char_length("value") >= least)
            .select("doc_id", "text_hash", "owner", "repo", "kind", "start", "end",
                    F.xxhash64("value").alias("value_hash")))


def ownership(found: DataFrame) -> DataFrame:
    """value_hash, n_owners, n_repos, n_docs, live: how widely a value is copied.
    Rows collapse per (value, owner, repository) before values meet."""
    per_repo = found.groupBy("value_hash", "owner", "repo").agg(F.count("*").alias("n"))
    some = lambda c: F.coalesce(F.xxhash64(c), F.lit(0))  # noqa: E731  the null owner is an owner
    return (per_repo.groupBy("value_hash")
            .agg(F.count_distinct(some("owner")).alias("n_owners"), F.count_distinct(some("repo")).alias("n_repos"),
                 F.sum("n").alias("n_docs"))
            .withColumn("live", (F.col("n_owners") < EXAMPLE_OWNERS)
                        & ((F.col("n_owners") < 2) | (F.col("n_repos") < EXAMPLE_REPOS))))


def secret_spans(docs: DataFrame) -> DataFrame:
    """All candidates of ``docs`` (doc_id, source, lang, text) with what the
    corpus says about their values: kind name, base, n_owners, n_repos, live."""
    found = written(candidates(docs), "secrets")
    owned = small_side(written(ownership(found), "owners"))
    names = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("kind") + 1)
    return found.join(owned, "value_hash").select(
        "doc_id", "text_hash", "owner", "repo", "kind", names.alias("name"), (F.col("kind") < len(BASE)).alias("base"),
        "start", "end", "value_hash", "n_owners", "n_repos", "n_docs", "live")


def secret_digest(docs: DataFrame) -> DataFrame:
    found = secret_spans(docs).where("base or live")
    # a text is one text whatever its source: copies of a row with another source give the same spans
    found = (found.groupBy("doc_id", "text_hash", "kind", "name", "base", "start", "end")
             .agg(F.max("live").alias("live")))
    entry = F.struct("start", "kind", F.concat_ws(":", "name", "start", "end").alias("said"))
    said = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["said"]), ",")
    per_text = (found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
                .agg(*[F.count_if(F.col("name") == k).alias(f"n_{k}") for k in BASE],
                     said(F.when(F.col("base"), entry)).alias("base"), said(entry).alias("spans")))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    every = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    return every.join(per_text, on, "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))
