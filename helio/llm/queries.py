"""The registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from helio.llm import (
    bpe,
    chat_format,
    conversation_repair,
    embedding_dedup,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    quality,
    substring_dedup,
    token_alignment,
    toxicity,
    winnowing,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id.query,
    "op2_embedding_near_dedup": embedding_dedup.query,
    "op3_substring_dedup": substring_dedup.query,
    "op4_winnowing": winnowing.query,
    "op5_quality_classifier": quality.query,
    "op6_retrieval_packing": packing.query,
    "op7_toxicity": toxicity.query,
    "op8_line_dedup": line_dedup.query,
    "op9_ngram_jaccard_join": ngram_join.query,
    "op10_bpe": bpe.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_chat_format": chat_format.query,
    "op13_token_alignment": token_alignment.query,
}

ORACLES: dict[str, str] = {
    "op2_embedding_near_dedup": embedding_dedup.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op9_ngram_jaccard_join": ngram_join.SQL,
}
