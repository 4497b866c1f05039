"""Registered queries of this subpackage, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import (bm25, chat, divergence, license_scan, line_dedup, mixing, ngram_join, oracle, packing, prefix_trie,
                        quality, secret_scan, toxicity, url_filter)
from txrisk.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": _over("documents", quality.quality_digest),
        "op2_source_mix": _over("documents", mixing.mix_digest),
        "op3_chat_format": _over("conversations", chat.chat_digest),
        "op4_jaccard_join": _over("documents", ngram_join.component_ids),
        "op5_license_scan": _over("documents", license_scan.license_digest),
        "op6_secret_scan": _over("documents", secret_scan.secret_digest),
        "op7_bm25_topk": _over("documents", bm25.bm25_digest),
        "op8_line_dedup": _over("documents", line_dedup.line_digest),
        "op9_toxicity": lambda spark, sf_dir: toxicity.toxicity(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op10_best_fit_packing": _over("documents", packing.packed),
        "op11_source_divergence": _over("documents", divergence.divergence),
        "op12_prefix_trie": _over("conversations", prefix_trie.prefix_trie),
        "op13_url_filter": _over("pages", url_filter.url_verdicts),
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
