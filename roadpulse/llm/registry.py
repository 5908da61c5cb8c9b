"""Queries of the text operators and the SQL they are checked against."""

from __future__ import annotations

from . import (
    alignment, exact_dedup, language, mixing, packing, quality_classifier, quality_rules, secrets, sharding, simhash, spelling, substring_dedup, warc,
)

_FOUND = {
    "op1_exact_dedup": (exact_dedup.op1_exact_dedup, exact_dedup.SQL),
    "op2_harmonic_packing": (packing.op2_harmonic_packing, None),
    "op3_secret_scan": (secrets.op3_secret_scan, None),
    "op4_sharding": (sharding.op4_sharding, sharding.SQL),
    "op5_simhash_near_dedup": (simhash.op5_simhash_near_dedup, None),
    "op6_source_mixing": (mixing.op6_source_mixing, None),
    "op7_substring_dedup": (substring_dedup.op7_substring_dedup, None),
    "op8_quality_classifier": (quality_classifier.op8_quality_classifier, None),
    "op9_quality_rules": (quality_rules.op9_quality_rules, quality_rules.SQL),
    "op10_warc_salvage": (warc.op10_warc_salvage, warc.SQL),
    "op11_token_alignment": (alignment.op11_token_alignment, None),
    "op12_spelling_variants": (spelling.op12_spelling_variants, None),
    "op13_language_id": (language.op13_language_id, None),
}


def queries() -> dict:
    return {name: run for name, (run, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _FOUND.items() if sql}
