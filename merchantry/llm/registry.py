"""The operators as registered queries over their whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from merchantry.llm import exact_dedup, line_dedup, main_text, mixing, near_dedup, pieces, prefix_trie, repair, token_counts, token_files, toxicity, vector_dedup, vector_search
from merchantry.llm.rows import table

Query = Callable[[SparkSession, str], DataFrame]


def over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


QUERIES: dict[str, Query] = {
    "op1_source_mixing": over("documents", mixing.mixed_documents),
    "op2_near_dedup": over("documents", near_dedup.deduped_documents),
    "op3_main_text": over("pages", main_text.extracted_pages),
    "op4_vector_dedup": over("embeddings", vector_dedup.deduped_vectors),
    "op5_vector_search": over("embeddings", vector_search.nearest_rows),
    "op6_line_dedup": over("documents", line_dedup.deduped_lines),
    "op7_piece_round_trip": over("documents", pieces.tokenized_documents),
    "op8_token_counts": over("documents", token_counts.counted_documents),
    "op9_toxicity": lambda spark, sf_dir: toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op10_token_files": over("documents", token_files.stored_documents),
    "op11_prefix_trie": over("conversations", prefix_trie.conversation_trie),
    "op12_exact_dedup": over("documents", exact_dedup.deduped_documents),
    "op13_conversation_repair": over("conversations", repair.repaired_conversations),
}

# only SQL text; the other operators have no SQL and are checked by brute force in their tests
ORACLES: dict[str, str] = {
    "op1_source_mixing": mixing.MIXED_SQL,
    "op6_line_dedup": line_dedup.DEDUPED_SQL,
    "op11_prefix_trie": prefix_trie.TRIE_SQL,
    "op12_exact_dedup": exact_dedup.DEDUPED_SQL,
    "op13_conversation_repair": repair.REPAIR_SQL,
}
