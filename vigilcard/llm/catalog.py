"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from vigilcard.llm import (
    chat_format, collocations, embedding_dedup, license_scan, ngram_join, packing, quality, quality_rules, resampling,
    source_mix, token_store, toxicity, vector_search,
)

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_token_store": token_store.query,
    "op3_source_mix": source_mix.query,
    "op4_quality_rules": quality_rules.query,
    "op5_chat_format": chat_format.query,
    "op6_quality_classifier": quality.query,
    "op7_packing": packing.query,
    "op8_license_scan": license_scan.query,
    "op9_embedding_dedup": embedding_dedup.query,
    "op10_ngram_join": ngram_join.query,
    "op11_vector_search": vector_search.query,
    "op12_resampling": resampling.query,
    "op13_collocations": collocations.query,
}

ORACLES: dict[str, str] = {
    "op3_source_mix": source_mix.ORACLE,
    "op5_chat_format": chat_format.ORACLE,
    "op8_license_scan": license_scan.oracle(),
    "op9_embedding_dedup": embedding_dedup.ORACLE,
    "op10_ngram_join": ngram_join.ORACLE,
    "op12_resampling": resampling.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
