"""Registered queries of the operators; ``ORACLE`` has SQL for those that SQL can express."""

from __future__ import annotations

from logweave.llm import (
    chat,
    column_packing,
    decontaminate,
    embedding_dedup,
    hard_negatives,
    jaccard_join,
    line_dedup,
    packing,
    quality,
    substring_dedup,
    token_alignment,
    token_counts,
    toxicity,
)
from logweave.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_line_dedup": line_dedup.query,
    "op3_ngram_jaccard_join": jaccard_join.query,
    "op4_best_fit_packing": packing.query,
    "op5_embedding_near_dedup": embedding_dedup.query,
    "op6_substring_dedup": substring_dedup.query,
    "op7_quality": quality.query,
    "op8_token_counts": token_counts.query,
    "op9_benchmark_decontamination": decontaminate.query,
    "op10_chat_formatting": chat.query,
    "op11_cross_tokenizer_alignment": token_alignment.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_column_packing": column_packing.query,
}
