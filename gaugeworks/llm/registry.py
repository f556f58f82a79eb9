"""The whole-table queries of this subpackage and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, embedding_dedup, hard_negatives, jaccard_join, language_id, mixing, prefix_trie, sharding, substring_dedup, token_counts, toxicity, url_filter, warc

_MODULES = {
    "op1_substring_dedup": substring_dedup,
    "op2_source_mixing": mixing,
    "op3_token_counts": token_counts,
    "op4_warc_bundles": warc,
    "op5_toxicity": toxicity,
    "op6_decontamination": decontaminate,
    "op7_jaccard_join": jaccard_join,
    "op8_embedding_dedup": embedding_dedup,
    "op9_url_filter": url_filter,
    "op10_sharding": sharding,
    "op11_prefix_trie": prefix_trie,
    "op12_hard_negatives": hard_negatives,
    "op13_language_id": language_id,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in _MODULES.items() if module.SQL}
