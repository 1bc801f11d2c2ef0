"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Query name: module of this package that has the function of that name.
MODULES = {
    "op1_toxicity": "toxicity",
    "op2_language": "language",
    "op3_bpe": "bpe",
    "op4_suffix_dedup": "suffix_dedup",
    "op5_topk": "topk",
    "op6_secrets": "secrets",
    "op7_decontaminate": "decontaminate",
    "op8_ngram_join": "ngram_join",
    "op9_substring_dedup": "substring_dedup",
    "op10_token_counts": "token_count",
    "op11_word_bpe": "word_bpe",
    "op12_ranked_search": "ranked_search",
    "op13_prefix_trie": "prefix_trie",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    from . import prefix_trie, ranked_search, topk

    return {"op5_topk": topk.ORACLE, "op12_ranked_search": ranked_search.ORACLE, "op13_prefix_trie": prefix_trie.ORACLE}
