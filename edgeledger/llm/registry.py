"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from edgeledger.llm import (
    anchor_tree,
    blob_ledger,
    block_names,
    byte_bpe,
    classifier_chain,
    decision_list,
    filter_audit,
    gru_lm,
    license_digests,
    minhash,
    pii_boost,
    poisson_mix,
    random_indexing,
)

QUERIES = {
    "op1_lm_score": gru_lm.op1_lm_score,
    "op2_license_scan": license_digests.op2_license_scan,
    "op3_quality_rules": decision_list.op3_quality_rules,
    "op4_near_dedup": minhash.op4_near_dedup,
    "op5_quality_classifier": random_indexing.op5_quality_classifier,
    "op6_personal_data": pii_boost.op6_personal_data,
    "op7_toxicity": classifier_chain.op7_toxicity,
    "op8_mix_sources": poisson_mix.op8_mix_sources,
    "op9_exact_dedup": block_names.op9_exact_dedup,
    "op10_byte_bpe": byte_bpe.op10_byte_bpe,
    "op11_secret_scan": blob_ledger.op11_secret_scan,
    "op12_hard_negatives": anchor_tree.op12_hard_negatives,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLES = {
    "op2_license_scan": license_digests.OP2_SQL,
    "op8_mix_sources": poisson_mix.OP8_SQL,
    "op9_exact_dedup": block_names.OP9_SQL,
    "op12_hard_negatives": anchor_tree.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
