"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from emporia.llm.op1_suffix_tree import op1_suffix_tree_scores
from emporia.llm.op10_licenses import op10_license_scan
from emporia.llm.op11_term_at_a_time import OP11_SQL, op11_term_at_a_time
from emporia.llm.op12_alignment import op12_shared_cut_alignment
from emporia.llm.op13_simhash import op13_simhash_components
from emporia.llm.op2_quality import OP2_SQL, op2_quality_ledger, op2_quality_ledger_learnt
from emporia.llm.op3_permutation import op3_permutation_search
from emporia.llm.op4_packing import op4_pattern_packing
from emporia.llm.op5_bpe import op5_bpe_roundtrip
from emporia.llm.op6_language import op6_language_mixture
from emporia.llm.op7_jaccard import op7_jaccard_components
from emporia.llm.op8_secrets import op8_secret_scan
from emporia.llm.op9_html import op9_html_main_text

QUERIES = {
    "op1_suffix_tree_scores": op1_suffix_tree_scores,
    "op2_quality_ledger": op2_quality_ledger,
    "op2_quality_ledger_learnt": op2_quality_ledger_learnt,
    "op3_permutation_search": op3_permutation_search,
    "op4_pattern_packing": op4_pattern_packing,
    "op5_bpe_roundtrip": op5_bpe_roundtrip,
    "op6_language_mixture": op6_language_mixture,
    "op7_jaccard_components": op7_jaccard_components,
    "op8_secret_scan": op8_secret_scan,
    "op9_html_main_text": op9_html_main_text,
    "op10_license_scan": op10_license_scan,
    "op11_term_at_a_time": op11_term_at_a_time,
    "op12_shared_cut_alignment": op12_shared_cut_alignment,
    "op13_simhash_components": op13_simhash_components,
}
ORACLE = {"op2_quality_ledger": OP2_SQL, "op11_term_at_a_time": OP11_SQL}
