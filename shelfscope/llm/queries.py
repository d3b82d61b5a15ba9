"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from shelfscope.llm import conversations, decontam, html_text, lexical, lines, lm, mixing, packing, quality, simhash, substring, token_counts, topk

QUERIES = {
    "op1_mix_sources": mixing.query,
    "op2_fuzzy_lines": lines.query,
    "op3_ordinal_quality": quality.query,
    "op4_html_text": html_text.query,
    "op5_fm_substrings": substring.query,
    "op6_ball_tree_topk": topk.query,
    "op7_latent_decontam": decontam.query,
    "op8_simhash_neardup": simhash.query,
    "op9_token_rollup": token_counts.query,
    "op10_lattice_score": lm.query,
    "op11_block_max_search": lexical.query,
    "op12_conversation_repair": conversations.query,
    "op13_pattern_packing": packing.query,
}

ORACLES = {
    "op1_mix_sources": mixing.ORACLE,
    "op5_fm_substrings": substring.ORACLE,
    "op6_ball_tree_topk": topk.ORACLE,
    "op11_block_max_search": lexical.ORACLE,
    "op12_conversation_repair": conversations.ORACLE,
}
