"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat, conversations, exact_dedup, fill_in_middle, fingerprints, language_id, licenses, lm_scoring, mixing, ngram_jaccard, quality, sentence_pieces, substring_dedup


def queries() -> dict:
    return {
        "op1_lm_scoring": lm_scoring.query,
        "op2_sentence_pieces": sentence_pieces.query,
        "op3_exact_dedup": exact_dedup.query,
        "op4_ngram_jaccard": ngram_jaccard.query,
        "op5_quality": quality.query,
        "op6_substring_dedup": substring_dedup.query,
        "op7_language_id": language_id.query,
        "op8_chat": chat.query,
        "op9_fingerprints": fingerprints.query,
        "op10_mixing": mixing.query,
        "op11_fill_in_middle": fill_in_middle.query,
        "op12_conversation_repair": conversations.query,
        "op13_licenses": licenses.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": exact_dedup.ORACLE, "op11_fill_in_middle": fill_in_middle.ORACLE, "op12_conversation_repair": conversations.ORACLE}
