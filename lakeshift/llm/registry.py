"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from lakeshift.llm import (
    bpe,
    conversations,
    decontaminate,
    embeddings,
    jaccard,
    licenses,
    line_dedup,
    phrases,
    quality,
    secrets,
    sharding,
    suffix_dedup,
    warc,
)

QUERIES = {
    "op1_bounded_ring": sharding.op1_bounded_ring,
    "op2_collection_bwt": suffix_dedup.op2_collection_bwt,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_markov_secrets": secrets.op4_markov_secrets,
    "op5_seeded_alignment": decontaminate.op5_seeded_alignment,
    "op6_license_templates": licenses.op6_license_templates,
    "op7_minhash_join": jaccard.op7_minhash_join,
    "op8_warc_transactions": warc.op8_warc_transactions,
    "op9_quality_ledger": quality.op9_quality_ledger,
    "op10_bpe_automaton": bpe.op10_bpe_automaton,
    "op11_scalar_repair": conversations.op11_scalar_repair,
    "op12_branch_and_bound": phrases.op12_branch_and_bound,
    "op13_residual_codes": embeddings.op13_residual_codes,
}

#: SQL where it runs on whole tables in reasonable time; the rest is tested by brute force.
ORACLE = {
    "op2_collection_bwt": suffix_dedup.ORACLE_OP2,
    "op3_line_dedup": line_dedup.ORACLE_OP3,
    "op8_warc_transactions": warc.ORACLE_OP8,
    "op9_quality_ledger": quality.ORACLE_OP9,
    "op12_branch_and_bound": phrases.ORACLE_OP12,
    "op13_residual_codes": embeddings.ORACLE_OP13,
}
