"""Queries of the text operators, by name, and the SQL for those that SQL can express."""

from __future__ import annotations

from cinderspark.llm import bpe, decontaminate, embedding_dedup, html_text, jaccard_join, langid, line_dedup, oracles, pitman_yor, sharding, token_counts


def queries() -> dict:
    return {
        "op1_pitman_yor": pitman_yor.query,
        "op2_embedding_dedup": embedding_dedup.query,
        "op3_decontamination": decontaminate.query,
        "op4_html_extraction": html_text.query,
        "op5_line_dedup": line_dedup.query,
        "op6_sharding": sharding.query,
        "op7_byte_bpe": bpe.query,
        "op8_language_id": langid.query,
        "op9_jaccard_join": jaccard_join.query,
        "op10_token_counts": token_counts.query,
    }


def oracle_sql() -> dict:
    """The others' models, ids and digests have no SQL; their tests compare with plain versions."""
    return {
        "op2_embedding_dedup": oracles.EMBEDDINGS,
        "op3_decontamination": oracles.LEAKS,
        "op5_line_dedup": oracles.LINES,
        "op9_jaccard_join": oracles.JACCARD,
    }
