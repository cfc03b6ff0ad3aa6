"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from loomspar.llm import chat_format, decontamination, html_extraction, lm_scoring, mixing, ngram_join, quality_rules, sharding, substring_dedup, token_counts

QUERIES = {
    "op1_chat_format": chat_format.query,
    "op2_ngram_join": ngram_join.query,
    "op3_quality_rules": quality_rules.query,
    "op4_substring_dedup": substring_dedup.query,
    "op5_html_extraction": html_extraction.query,
    "op6_mixing": mixing.query,
    "op7_lm_scoring": lm_scoring.query,
    "op8_sharding": sharding.query,
    "op9_decontamination": decontamination.query,
    "op10_token_counts": token_counts.query,
}
SQL = {
    "op1_chat_format": chat_format.SQL,
    "op2_ngram_join": ngram_join.SQL,
    "op4_substring_dedup": substring_dedup.SQL,
    "op9_decontamination": decontamination.SQL,
}
