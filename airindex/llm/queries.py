"""Registered queries of the corpus operators: each over its whole intended table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airindex.llm import (chat_format, conversation_trie, decontaminate, embedding_dedup, line_dedup, merkle_manifest, mixing,
                          near_dup, quality_classifier, quality_rules, substring_dedup, suffix_dedup, token_counts)
from airindex.llm.common import table


def _over(fn, *names: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(*[table(spark, sf_dir, name) for name in names])
    return query


QUERIES = {
    "op1_substring_dedup": _over(substring_dedup.op1, "documents"),
    "op2_mix_to_weights": _over(mixing.op2, "documents"),
    "op3_line_dedup": _over(line_dedup.op3, "documents"),
    "op4_decontaminate": _over(decontaminate.op4, "documents", "benchmark"),
    "op5_token_counts": _over(token_counts.op5, "documents"),
    "op6_quality_rules": _over(quality_rules.op6, "documents"),
    "op7_chat_format": _over(chat_format.op7, "conversations"),
    "op8_suffix_dedup": _over(suffix_dedup.op8, "documents"),
    "op9_quality_classifier": _over(quality_classifier.op9, "documents", "labels"),
    "op10_near_dup": _over(near_dup.op10, "documents"),
    "op11_conversation_trie": _over(conversation_trie.op11, "conversations"),
    "op12_embedding_near_dup": _over(embedding_dedup.op12, "embeddings"),
    "op13_merkle_manifest": _over(merkle_manifest.op13, "documents"),
}
ORACLE = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op3_line_dedup": line_dedup.SQL,
    "op4_decontaminate": decontaminate.SQL,
    "op6_quality_rules": quality_rules.SQL,
    "op7_chat_format": chat_format.SQL,
    "op8_suffix_dedup": suffix_dedup.SQL,
    "op10_near_dup": near_dup.SQL,
    "op11_conversation_trie": conversation_trie.SQL,
    "op12_embedding_near_dup": embedding_dedup.SQL,
    "op13_merkle_manifest": merkle_manifest.SQL,
}
