"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from ledgerspark.llm import (conversations, imatch, mixing, near_dedup, pii, quality_model, quality_rules, substring_dedup, suffix_dedup,
                             tokenise, toxicity, warc, whitening)

QUERIES = {
    "op1_quality_model": quality_model.query,
    "op2_mix_sources": mixing.query,
    "op3_suffix_dedup": suffix_dedup.query,
    "op4_near_dedup": near_dedup.query,
    "op5_toxicity": toxicity.query,
    "op6_imatch": imatch.query,
    "op7_warc": warc.query,
    "op8_quality_rules": quality_rules.query,
    "op9_substring_dedup": substring_dedup.query,
    "op10_sentencepiece": tokenise.query,
    "op11_whitening": whitening.query,
    "op12_pii": pii.query,
    "op13_conversations": conversations.query,
}
ORACLE_SQL = {
    "op2_mix_sources": mixing.SQL,
    "op3_suffix_dedup": suffix_dedup.SQL,
    "op4_near_dedup": near_dedup.SQL,
    "op7_warc": warc.SQL,
    "op9_substring_dedup": substring_dedup.SQL,
    "op13_conversations": conversations.SQL,
}
