"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from backdrop.llm import (
    alignment,
    bpe_chunks,
    decontamination,
    exact_dedup,
    fill_middle,
    language,
    lm_scoring,
    near_dedup,
    packing,
    pii,
    sharding,
    token_counts,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hash_tree_sharding": sharding.op1_hash_tree_sharding,
    "op2_chunked_bpe": bpe_chunks.op2_chunked_bpe,
    "op3_cgk_decontamination": decontamination.op3_cgk_decontamination,
    "op4_hyperdimensional_language": language.op4_hyperdimensional_language,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_weighted_minhash_dedup": near_dedup.op6_weighted_minhash_dedup,
    "op7_context_tree_weighting": lm_scoring.op7_context_tree_weighting,
    "op8_bigru_toxicity": toxicity.op8_bigru_toxicity,
    "op9_information_theoretic_pii": pii.op9_information_theoretic_pii,
    "op10_content_sort_dedup": exact_dedup.op10_content_sort_dedup,
    "op11_distinct_text_alignment": alignment.op11_distinct_text_alignment,
    "op12_fenwick_fill_in_middle": fill_middle.op12_fenwick_fill_in_middle,
    "op13_bin_completion_packing": packing.op13_bin_completion_packing,
}

ORACLE: dict[str, str] = {
    "op10_content_sort_dedup": exact_dedup.ORACLE_SQL.strip(),
    "op12_fenwick_fill_in_middle": fill_middle.ORACLE_SQL.strip(),
}
