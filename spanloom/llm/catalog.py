"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from spanloom.llm import queries, reference_sql

QUERIES = {
    "op1_chat_format": queries.op1_chat_format,
    "op2_feistel_pseudonyms": queries.op2_feistel_pseudonyms,
    "op3_line_frequency": queries.op3_line_frequency,
    "op4_fourier_quality": queries.op4_fourier_quality,
    "op5_pitman_yor": queries.op5_pitman_yor,
    "op6_spaced_seeds": queries.op6_spaced_seeds,
    "op7_jaccard_forest": queries.op7_jaccard_forest,
    "op8_suffix_automata": queries.op8_suffix_automata,
    "op9_bpe": queries.op9_bpe,
    "op10_license_scan": queries.op10_license_scan,
    "op11_token_alignment": queries.op11_token_alignment,
    "op12_lexical_search": queries.op12_lexical_search,
    "op13_secret_scan": queries.op13_secret_scan,
}
ORACLE_SQL = {
    "op1_chat_format": reference_sql.OP1,
    "op3_line_frequency": reference_sql.OP3,
    "op6_spaced_seeds": reference_sql.OP6,
    "op7_jaccard_forest": reference_sql.OP7,
    "op8_suffix_automata": reference_sql.OP8,
    "op10_license_scan": reference_sql.OP10,
    "op12_lexical_search": reference_sql.OP12,
}
