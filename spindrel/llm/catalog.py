"""The registered queries of the corpus operators: opN_<name>(spark, folder of tables), at production parameters."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

#: query name -> module of this folder that holds query() and, where SQL can express it, ORACLE_SQL.
OPERATORS = {
    "op1_pack": "packing",
    "op2_quality_rules": "quality_rules",
    "op3_embedding_dedup": "embedding_dedup",
    "op4_chat_format": "chat_format",
    "op5_substring_dedup": "substring_dedup",
    "op6_mix_sources": "mixing",
    "op7_simhash_dedup": "simhash_dedup",
    "op8_quality_classifier": "quality_classifier",
    "op9_language_id": "language_id",
    "op10_url_filter": "url_filter",
    "op11_centroid_clusters": "centroid_clusters",
    "op12_prefix_trie": "prefix_trie",
    "op13_toxicity": "toxicity",
}


def _modules() -> dict:
    return {name: import_module(f"spindrel.llm.{module}") for name, module in OPERATORS.items()}


def queries() -> dict[str, Callable]:
    own = _modules()
    return {name: m.query for name, m in own.items()} | {"rule_ablations": own["op2_quality_rules"].ablation_query}


def oracle_sql() -> dict[str, str]:
    own = _modules()
    return {name: m.ORACLE_SQL for name, m in own.items() if m.ORACLE_SQL} | {"rule_ablations": own["op2_quality_rules"].ABLATION_SQL}
