"""Registered queries of the training-data operators and the SQL they are checked against."""

from lexcurate.llm import bpe, exact_dedup, hard_negatives, maxent_lm, minhash, packing, quality, secrets, suffix_dedup, token_counts, topk, url_filters, whitening

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_url_filters": url_filters.op2_url_filters,
    "op3_topk": topk.op3_topk,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_bpe": bpe.op6_bpe,
    "op7_minhash": minhash.op7_minhash,
    "op8_lm_scores": maxent_lm.op8_lm_scores,
    "op9_quality": quality.op9_quality,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_whitening": whitening.op12_whitening,
    "op13_secrets": secrets.op13_secrets,
}

ORACLE_SQL = {
    "op2_url_filters": url_filters.OP2_SQL,
    "op3_topk": topk.OP3_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
}
