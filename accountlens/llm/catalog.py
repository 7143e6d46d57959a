"""The registered queries of this subpackage and their DuckDB oracle SQL."""

from __future__ import annotations

from accountlens.llm import (chat, decontamination, hard_negatives, html_templates, mixing, pii, quality_rules, sharding, simhash,
                             token_binary, token_counts, toxicity, vector_codes)

QUERIES = {
    "op1_token_counts": token_counts.counted_documents,
    "op2_sharding": sharding.sharded_documents,
    "op3_quality_rules": quality_rules.judged_documents,
    "op4_pii": pii.private_documents,
    "op5_decontamination": decontamination.leaked_documents,
    "op6_chat_format": chat.rotated_conversations,
    "op7_simhash": simhash.linked_documents,
    "op8_source_mix": mixing.mixed_documents,
    "op9_toxicity": toxicity.toxic_documents,
    "op10_token_ids": token_binary.tokenized_documents,
    "op11_vector_codes": vector_codes.coded_embeddings,
    "op12_html_extraction": html_templates.extracted_pages,
    "op13_hard_negatives": hard_negatives.mined_embeddings,
}

#: The others have no SQL: they are tested against brute force, an exact round trip or held-out accuracy.
ORACLE = {
    "op2_sharding": sharding.ORACLE_SQL,
    "op3_quality_rules": quality_rules.ORACLE_SQL,
    "op5_decontamination": decontamination.ORACLE_SQL,
    "op6_chat_format": chat.ORACLE_SQL,
    "op11_vector_codes": vector_codes.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
