"""Queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from tessera.llm import (decontaminate, hard_negatives, hmm_lm, jaccard_bayes, line_dedup, lz_fingerprint, mixing, pii_gbt, quality_mcd, sharding,
                         sp_nbest, warc_zip, whitening)

QUERIES = {
    "op1_gbt_pii": pii_gbt.op1_gbt_pii,
    "op2_external_shuffle": sharding.op2_external_shuffle,
    "op3_hmm_scores": hmm_lm.op3_hmm_scores,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_nbest_pieces": sp_nbest.op5_nbest_pieces,
    "op6_zip_warc": warc_zip.op6_zip_warc,
    "op7_block_mix": mixing.op7_block_mix,
    "op8_bayes_jaccard": jaccard_bayes.op8_bayes_jaccard,
    "op9_lz_phrases": lz_fingerprint.op9_lz_phrases,
    "op10_robust_outliers": quality_mcd.op10_robust_outliers,
    "op11_benchmark_ngrams": decontaminate.op11_benchmark_ngrams,
    "op12_slot_negatives": hard_negatives.op12_slot_negatives,
    "op13_feast_whitening": whitening.op13_feast_whitening,
}
ORACLE_SQL = {
    "op4_line_dedup": line_dedup.SQL,
    "op6_zip_warc": warc_zip.SQL,
    "op11_benchmark_ngrams": decontaminate.SQL,
    "op12_slot_negatives": hard_negatives.SQL,
}
