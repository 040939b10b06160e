"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import chat, prefix_trie, quality_rules, spelling, url_filter
from tokenloom.llm.bin_packing import op12_min_bin_slack
from tokenloom.llm.embedding_dedup import op1_embedding_pq
from tokenloom.llm.minhash import op6_minhash
from tokenloom.llm.mixing import op9_pareto_mix
from tokenloom.llm.packing import op3_hilbert_packing
from tokenloom.llm.quality_classifier import op5_cotraining
from tokenloom.llm.sharding import op4_histogram_sort
from tokenloom.llm.toxicity import op2_zstd_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_pq": op1_embedding_pq,
        "op2_zstd_toxicity": op2_zstd_toxicity,
        "op3_hilbert_packing": op3_hilbert_packing,
        "op4_histogram_sort": op4_histogram_sort,
        "op5_cotraining": op5_cotraining,
        "op6_minhash": op6_minhash,
        "op7_quality_rules": quality_rules.op7_quality_rules,
        "op8_chat_format": chat.op8_chat_format,
        "op9_pareto_mix": op9_pareto_mix,
        "op10_url_filter": url_filter.op10_url_filter,
        "op11_spelling": spelling.op11_spelling,
        "op12_min_bin_slack": op12_min_bin_slack,
        "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where SQL can express the operator; what the others are tested against is in README."""
    return {
        "op7_quality_rules": quality_rules.oracle(),
        "op8_chat_format": chat.oracle(),
        "op10_url_filter": url_filter.oracle(),
        "op11_spelling": spelling.oracle(),
        "op13_prefix_trie": prefix_trie.oracle(),
    }
