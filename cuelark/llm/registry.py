"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import exact_dedup, hard_negatives, language_id, lexical_search, licenses, lm_scoring, mixing, near_dedup, pieces, quality_classifier, quality_rules, sentence_spans, suffixes


def queries() -> dict:
    return {
        "op1_minhash_near_dedup": near_dedup.op1_minhash_near_dedup,
        "op2_license_scan": licenses.op2_license_scan,
        "op3_quality_classifier": quality_classifier.op3_quality_classifier,
        "op4_source_mixing": mixing.op4_source_mixing,
        "op5_substring_dedup": sentence_spans.op5_substring_dedup,
        "op6_suffix_array_dedup": suffixes.op6_suffix_array_dedup,
        "op7_quality_rules": quality_rules.op7_quality_rules,
        "op8_exact_dedup": exact_dedup.op8_exact_dedup,
        "op9_sentencepiece": pieces.op9_sentencepiece,
        "op10_lm_scoring": lm_scoring.op10_lm_scoring,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_language_id": language_id.op12_language_id,
        "op13_lexical_search": lexical_search.op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_scan": licenses.SQL,
        "op4_source_mixing": mixing.SQL,
        "op8_exact_dedup": exact_dedup.SQL,
        "op11_hard_negatives": hard_negatives.SQL,
        "op13_lexical_search": lexical_search.SQL,
    }
