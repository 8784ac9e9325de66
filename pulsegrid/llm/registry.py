"""Queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from . import decontaminate, fingerprint, jaccard_join, language_id, lm_score, packing, quality_rules, sharding, substring_dedup, token_counts

QUERIES = {
    "op1_token_counts": token_counts.query,
    "op2_lm_scoring": lm_score.query,
    "op3_quality_classifier": quality_rules.query,
    "op4_packing": packing.query,
    "op5_benchmark_decontamination": decontaminate.query,
    "op6_sharding": sharding.query,
    "op7_document_fingerprints": fingerprint.query,
    "op8_substring_dedup": substring_dedup.query,
    "op9_language_id": language_id.query,
    "op10_ngram_jaccard_join": jaccard_join.query,
}

ORACLES = {
    "op5_benchmark_decontamination": decontaminate.ORACLE,
    "op8_substring_dedup": substring_dedup.ORACLE,
}
