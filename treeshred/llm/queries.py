"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from treeshred.llm import (bpe, divergence, exact_dedup, language, licenses, line_dedup, mixing, near_dup, prefix_trie,
                           quality, quality_rules, secrets, token_files)

QUERIES = {
    "op1_language": language.op1_language,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_bpe": bpe.op3_bpe,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_token_files": token_files.op5_token_files,
    "op6_quality": quality.op6_quality,
    "op7_licenses": licenses.op7_licenses,
    "op8_near_dup": near_dup.op8_near_dup,
    "op9_secrets": secrets.op9_secrets,
    "op10_mixing": mixing.op10_mixing,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_line_dedup": line_dedup.op13_line_dedup,
}

ORACLES = {
    "op2_quality_rules": quality_rules.OP2_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op7_licenses": licenses.OP7_SQL,
    "op8_near_dup": near_dup.OP8_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_source_divergence": divergence.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_line_dedup": line_dedup.OP13_SQL,
}
