"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from cartlark.llm import (
    decontaminate,
    exact_topk,
    hard_negatives,
    language_id,
    near_dup,
    packing,
    quotes,
    sharding,
    substring_dedup,
    token_alignment,
    token_counts,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_chat_quotes": quotes.op4_chat_quotes,
    "op5_sharding": sharding.op5_sharding,
    "op6_exact_topk": exact_topk.op6_exact_topk,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_near_dup": near_dup.op8_near_dup,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_language_id": language_id.op10_language_id,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_substring_dedup": substring_dedup.op13_substring_dedup,
}

ORACLE: dict[str, str] = {
    "op4_chat_quotes": quotes.OP4_SQL,
    "op6_exact_topk": exact_topk.OP6_SQL,
    "op7_url_filter": url_filter.OP7_SQL,
    "op8_near_dup": near_dup.OP8_SQL,
    "op9_decontamination": decontaminate.OP9_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op13_substring_dedup": substring_dedup.OP13_SQL,
}
