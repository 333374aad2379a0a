"""Queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from . import decontaminate, fim, html, lm, mix, neardup, phrases, pieces, quality, rules, substrings, tokens, urls


def queries() -> dict:
    return {
        "op1_substring_dedup": substrings.op1_substring_dedup,
        "op2_quality_rules": rules.op2_quality_rules,
        "op3_lm_scores": lm.op3_lm_scores,
        "op4_mix": mix.op4_mix,
        "op5_near_dedup": neardup.op5_near_dedup,
        "op6_main_text": html.op6_main_text,
        "op7_url_filters": urls.op7_url_filters,
        "op8_quality_classifier": quality.op8_quality_classifier,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_token_ids": tokens.op10_token_ids,
        "op11_sentence_pieces": pieces.op11_sentence_pieces,
        "op12_fill_in_middle": fim.op12_fill_in_middle,
        "op13_phrases": phrases.op13_phrases,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": substrings.ORACLE,
        "op2_quality_rules": rules.ORACLE,
        "op4_mix": mix.ORACLE,
        "op5_near_dedup": neardup.ORACLE,
        "op7_url_filters": urls.ORACLE,
        "op9_decontaminate": decontaminate.ORACLE,
        "op12_fill_in_middle": fim.ORACLE,
        "op13_phrases": phrases.ORACLE,
    }
