"""Queries of the numbered operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from fleetframe.llm import (
    byte_bpe,
    decontaminate,
    embedding_dedup,
    language_id,
    lexical_search,
    line_dedup,
    minhash,
    quality_rules,
    secret_scan,
    token_alignment,
    token_counts,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_minhash": minhash.op1_minhash,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_embedding_dedup": embedding_dedup.op4_embedding_dedup,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_quality_rules": quality_rules.op13_quality_rules,
}
SQL: dict[str, str] = {
    "op2_url_filter": url_filter.OP2_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op9_line_dedup": line_dedup.OP9_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
}
