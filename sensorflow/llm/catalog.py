"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from sensorflow.llm import (alignment, bpe, embeddings, exact_dedup, html_text, lexical, licenses, maxent, mixing, sharding,
                            simhash, suffixes, toxicity)

LLM_QUERIES = {
    "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
    "op2_html_extraction": html_text.op2_html_extraction,
    "op3_lm_scoring": maxent.op3_lm_scoring,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_embedding_near_dedup": embeddings.op5_embedding_near_dedup,
    "op6_mixing": mixing.op6_mixing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_bpe": bpe.op8_bpe,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_sharding": sharding.op10_sharding,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_suffix_dedup": suffixes.op12_suffix_dedup,
    "op13_alignment": alignment.op13_alignment,
}

# The other queries hash, learn or search in ways that SQL cannot express; tests hold them against brute force.
LLM_ORACLE = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op9_license_scan": licenses.oracle(),
    "op11_lexical_search": lexical.ORACLE,
}
