"""The queries of the operators and the pipeline, and their SQL."""

from __future__ import annotations

from acctweave.llm import (
    byte_bpe,
    chat_format,
    conversation_repair,
    fingerprint,
    html_text,
    language_id,
    near_dedup,
    packing,
    quality_rules,
    substring_dedup,
    toxicity,
    vector_codes,
    vector_dedup,
)

QUERIES = {
    "op1_html_text": html_text.query,
    "op2_vector_dedup": vector_dedup.query,
    "op3_toxicity": toxicity.query,
    "op4_substring_dedup": substring_dedup.query,
    "op5_chat_format": chat_format.query,
    "op6_language_id": language_id.query,
    "op7_near_dedup": near_dedup.query,
    "op8_fingerprint": fingerprint.query,
    "op9_packing": packing.query,
    "op10_byte_bpe": byte_bpe.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_vector_codes": vector_codes.query,
    "op13_quality_rules": quality_rules.query,
}

ORACLE = {
    "op4_substring_dedup": substring_dedup.SQL,
    "op5_chat_format": chat_format.SQL,
    "op11_conversation_repair": conversation_repair.SQL,
    "op12_vector_codes": vector_codes.SQL,
    "op13_quality_rules": quality_rules.SQL,
}
