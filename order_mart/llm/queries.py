"""Registered queries of this subpackage and their DuckDB oracle SQL."""

from __future__ import annotations

from . import bpe_words, chat_format, exact_dedup, langid_ecoc, ngram_join, packing, ppm_scoring, quality_bands, rindex_dedup, threshold_clustering, token_alignment, toxicity_nbsvm, url_filter

QUERIES = {
    "op1_bpe_words": bpe_words.op1_bpe_words,
    "op2_langid_ecoc": langid_ecoc.op2_langid_ecoc,
    "op3_rindex_dedup": rindex_dedup.op3_rindex_dedup,
    "op4_toxicity_nbsvm": toxicity_nbsvm.op4_toxicity_nbsvm,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_chat_format": chat_format.op6_chat_format,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_quality_bands": quality_bands.op8_quality_bands,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op11_ppm_scores": ppm_scoring.op11_ppm_scores,
    "op12_threshold_clusters": threshold_clustering.op12_threshold_clusters,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

ORACLES = {
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op6_chat_format": chat_format.OP6_SQL,
    "op12_threshold_clusters": threshold_clustering.OP12_SQL,
}
