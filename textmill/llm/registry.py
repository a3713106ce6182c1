"""The operators' queries and, where SQL can express them, their oracles."""

from __future__ import annotations

from textmill.llm import bpe, chat, crf, exact_dedup, hard_negatives, langid, line_dedup, near_dedup
from textmill.llm import packing, phrases, quality_rules, substring_dedup, suffix_dedup


def queries():
    return {
        "op1_best_fit_packing": packing.op1_best_fit_packing,
        "op2_bpe": bpe.op2_bpe,
        "op3_quality_crf": crf.op3_quality_crf,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
        "op6_exact_dedup": exact_dedup.op6_exact_dedup,
        "op7_quality_rules": quality_rules.op7_quality_rules,
        "op8_near_dedup": near_dedup.op8_near_dedup,
        "op9_substring_dedup": substring_dedup.op9_substring_dedup,
        "op10_chat": chat.op10_chat,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_language_id": langid.op12_language_id,
        "op13_phrases": phrases.op13_phrases,
    }


def oracle_sql():
    return {
        "op5_suffix_dedup": suffix_dedup.OP5_SQL,
        "op6_exact_dedup": exact_dedup.OP6_SQL,
        "op8_near_dedup": near_dedup.OP8_SQL,
        "op9_substring_dedup": substring_dedup.OP9_SQL,
        "op10_chat": chat.OP10_SQL,
        "op11_hard_negatives": hard_negatives.OP11_SQL,
        "op13_phrases": phrases.OP13_SQL,
    }
