"""URL filter: given rules by host and path, and rules mined from what they decide.

A given rule (host, path, verdict) fits its host and the host's subdomains where the
url's path starts with the rule's path; the longest one (host and path in
characters, then the longer host) decides.  Urls that no given rule fits go by
association rules: Spark's FP-growth mines combinations of url tokens and label from
the labelled urls; a rule stays if it has ``MIN_SUPPORT`` of the labelled rows,
``MIN_CONFIDENCE``, more confidence than its label's share, and more than the same
rule with any one token left out.  Rules are matched by an inverted index: a rule
is listed under its rarest token, found by that and then verified.  The most
confident rule decides (then the one with more rows, then the greatest tokens);
where none matches, the verdict is ``DEFAULT``.

Before mining, tokens that all labelled rows have are left out, as they tell
nothing, and of tokens that occur in the very same labelled rows the most general
one stands for all, in the labelled rows and in the others (which have it if they
have any of them); so a common url of many tokens is not mined as the set of all
its subsets.  Everything is built of DataFrame functions and Spark's own FP-growth.

Tokens of a url: scheme, last host label, last two labels, host, words of the other
labels, directories, words of the last path segment with numbers as ``0``, its
extension, keys of the query, and the fragment; A-Z lower-cased.

Defined results: a null url, or one without ``://``, has an empty host and path, no
token, no rule and the verdict ``DEFAULT``; so has every url if nothing is labelled
and no given rule fits; repeated rows each have a row and count as often in mining;
an empty table gives no rows; other columns of ``pages`` are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import small_side, written

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"
#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Kinds of token, the general ones first.
KINDS = ("tld", "dir", "word", "ext", "query", "scheme", "fragment", "domain", "host", "leaf")
_LABEL = "label:"


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _parsed(pages: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and (scheme, host, path, tail): of a url without ``://`` all empty."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rows = pages.select(*keep, F.when(at > 0, F.left(url, at - 1)).otherwise("").alias("scheme"),
                        F.when(at > 0, F.substr(url, at + 3)).otherwise("").alias("rest"))
    rows = rows.withColumn("raw", F.regexp_extract("rest", "^[^/?#]*", 0))
    rows = rows.withColumn("rest", F.substr("rest", F.char_length("raw") + 1))
    rows = rows.withColumn("path", F.regexp_extract("rest", "^[^?#]*", 0))
    return rows.select(*keep, "scheme", _lower(F.col("raw")).alias("host"), "path",
                       F.substr("rest", F.char_length("path") + 1).alias("tail"))


def _given(rules: Sequence[tuple[str, str, str]]) -> Column:
    """The rule (name, verdict) that decides a parsed url, or null."""
    best = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0]), r))
    if not best:
        return F.lit(None).cast("struct<name:string,verdict:string>")
    known = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(h + p).alias("name"), F.lit(v).alias("verdict"))
                      for h, p, v in best])
    fits = F.filter(known, lambda r: ((F.col("host") == r["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["host"])))
                    & F.startswith(F.col("path"), r["path"]))
    first = F.get(fits, F.lit(0))
    return F.when(first.isNotNull(), F.struct(first["name"].alias("name"), first["verdict"].alias("verdict")))


def _tokens() -> Column:
    """The distinct tokens of a parsed url, sorted."""
    def each(kind: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(f"{kind}:"), v))

    def words(text: Column) -> Column:
        return F.split(text, "[^a-z0-9\\x{80}-\\x{10FFFF}]+")

    labels = F.split("host", "\\.")
    n = F.size(labels)
    parts = F.split(_lower(F.col("path")), "/")
    leaf = F.element_at(parts, -1)
    query = F.regexp_extract(_lower(F.col("tail")), "^\\?([^#]*)", 1)
    out = F.concat(
        each("scheme", F.array(_lower(F.col("scheme")))),
        each("tld", F.array(F.element_at(labels, -1))),
        F.when(n > 1, each("domain", F.array(F.concat_ws(".", F.slice(labels, -2, 2))))).otherwise(F.array().cast("array<string>")),
        each("host", F.array("host")),
        each("word", words(F.array_join(F.slice(labels, 1, F.greatest(n - 1, F.lit(0))), "."))),
        each("dir", F.slice(parts, 1, F.size(parts) - 1)),
        each("leaf", words(F.regexp_replace(F.regexp_replace(leaf, "\\.[^.]*$", ""), "[0-9]+", "0"))),
        each("ext", F.array(F.regexp_extract(leaf, "\\.([^.]*)$", 1))),
        each("query", F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, "^[^=]*", 0))),
        each("fragment", F.array(F.regexp_extract(_lower(F.col("tail")), "(?s)#(.*)", 1))))
    return F.sort_array(F.array_distinct(out))


def _classes(labelled: DataFrame, n: int) -> Column:
    """A map of the frequent tokens, each to the one that stands for all tokens of
    the same labelled rows, as a scalar: tokens over MIN_SUPPORT are few."""
    row = F.xxhash64("page_id", "items").cast("decimal(20,0)")
    kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.substring_index("token", ":", 1))
    counts = (labelled.select(F.explode("items").alias("token"), row.alias("row")).groupBy("token")
              .agg(F.count(F.lit(1)).alias("rows"), F.sum("row").alias("sum")))
    sets = (counts.where((F.col("rows") < n) & (F.col("rows") >= MIN_SUPPORT * n)).groupBy("rows", "sum")
            .agg(F.min_by("token", F.struct(kind, F.col("token"))).alias("for_all"), F.collect_list("token").alias("tokens")))
    return (sets.select(F.explode("tokens").alias("token"), "for_all")
            .agg(F.map_from_entries(F.collect_list(F.struct("token", "for_all")))).scalar())


def _classed(df: DataFrame, classes: Column) -> DataFrame:
    """``df`` with the tokens that rules speak of in place of its own."""
    found = F.transform("items", lambda t: F.try_element_at("_classes", t))
    return (df.withColumn("_classes", classes)
            .withColumn("items", F.sort_array(F.array_distinct(F.filter(found, lambda t: t.isNotNull())))).drop("_classes"))


def mine(labelled: DataFrame) -> tuple[DataFrame, Column]:
    """Rules (tokens sorted, verdict, rows, confidence, rarest) of the labelled rows
    (page_id, items, label), and the map of tokens to those that rules speak of."""
    spark = labelled.sparkSession
    schema = "tokens array<string>, verdict string, rows long, confidence double, rarest string"
    shares = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}  # a row per verdict
    n = sum(shares.values())
    if not n:
        return spark.createDataFrame([], schema), F.create_map().cast("map<string,string>")
    classes = _classes(labelled, n)
    baskets = _classed(labelled, classes).select(F.concat("items", F.array(F.concat(F.lit(_LABEL), F.col("label")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=MIN_SUPPORT, minConfidence=1.0).fit(baskets)
    sets = written(model.freqItemsets.select(F.sort_array("items").alias("items"), "freq"), "url-itemsets")
    is_label = lambda t: F.startswith(t, F.lit(_LABEL))
    plain = sets.where(~F.exists("items", is_label)).select(F.col("items").alias("tokens"), F.col("freq").alias("all"))
    own = (sets.where(F.exists("items", is_label) & (F.size("items") > 1))
           .select(F.filter("items", lambda t: ~is_label(t)).alias("tokens"),
                   F.substr(F.get(F.filter("items", is_label), F.lit(0)), F.lit(len(_LABEL) + 1)).alias("verdict"),
                   F.col("freq").alias("rows")))
    share = F.create_map(*[F.lit(x) for kv in shares.items() for x in (kv[0], kv[1] / n)])
    every = own.join(plain, "tokens").withColumn("confidence", F.col("rows") / F.col("all"))
    shorter = (every.where((F.size("tokens") > 1) & (F.col("confidence") >= MIN_CONFIDENCE))
               .select("tokens", "verdict", "confidence", F.explode("tokens").alias("out"))
               .withColumn("less", F.array_remove("tokens", F.col("out")))
               .join(every.select(F.col("tokens").alias("less"), "verdict", F.col("confidence").alias("have")), ["less", "verdict"])
               .where("have >= confidence").select("tokens", "verdict").distinct())
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("freq").alias("token_rows"))
    stay = (every.where((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("confidence") > share[F.col("verdict")]))
            .join(shorter, ["tokens", "verdict"], "left_anti"))
    rules = written(stay.withColumn("token", F.explode("tokens")).join(single, "token")
                    .groupBy("tokens", "verdict", "rows", "confidence")
                    .agg(F.min_by("token", F.struct("token_rows", "token")).alias("rarest")), "url-rules")
    return rules, classes


def _matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(items, verdict, tokens, confidence): the best rule of each set of tokens that
    one fits."""
    best = F.max(F.struct("confidence", "rows", "tokens", "verdict")).alias("best")
    return (sets.withColumn("rarest", F.explode("items")).join(small_side(rules), "rarest")
            .where(F.size(F.array_intersect("items", "tokens")) == F.size("tokens"))
            .groupBy("items").agg(best).select("items", "best.verdict", "best.tokens", "best.confidence"))


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labels: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, learned, confidence) of every row of
    ``pages`` (page_id, url).  ``labels`` (page_id, url, label) are the labelled urls;
    by default those that a given rule decides, with its verdict.  ``learned`` has
    the tokens of the mined rule that decided."""
    parsed = written(_parsed(pages, "page_id").withColumn("given", _given(rules)).withColumn("items", _tokens())
                     .select("page_id", "host", "path", "given", "items"), "urls")
    decided, open_ = parsed.where("given IS NOT NULL"), parsed.where("given IS NULL")
    if labels is None:
        labelled = decided.select("page_id", "items", F.col("given.verdict").alias("label"))
    else:
        labelled = (_parsed(labels.where("label IS NOT NULL"), "page_id", "label").withColumn("items", _tokens())
                    .select("page_id", "items", "label"))
    rules_, classes = mine(labelled)
    open_ = _classed(open_, classes)
    found = _matched(open_.select("items").distinct(), rules_)
    names = ["page_id", "host", "path"]
    mined = open_.join(found, "items", "left").select(
        *names, F.lit(None).cast("string").alias("rule"), F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"),
        F.array_join("tokens", " ").alias("learned"), "confidence")
    return decided.select(*names, "given.name", "given.verdict", F.lit(None).cast("string"), F.lit(None).cast("double")
                          ).toDF(*mined.columns).unionByName(mined)
