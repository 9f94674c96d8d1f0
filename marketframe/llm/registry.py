"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from marketframe.llm.annsearch import op5_multi_index_hashing
from marketframe.llm.bpe import op3_bpe
from marketframe.llm.chat import chat_sql, op10_chat_formatting
from marketframe.llm.hardneg import negatives_sql, op13_cover_tree_negatives
from marketframe.llm.katz import op2_katz
from marketframe.llm.langid import op11_language_id
from marketframe.llm.merkle import merkle_sql, op12_merkle_manifest
from marketframe.llm.mixing import op1_mixing
from marketframe.llm.neardup import op9_near_duplicates
from marketframe.llm.quality import op8_quality_rules, quality_sql
from marketframe.llm.revisits import op7_revisits, revisits_sql
from marketframe.llm.substring import op6_substring_dedup
from marketframe.llm.tokenfiles import op4_token_files

LLM_QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_katz": op2_katz,
    "op3_bpe": op3_bpe,
    "op4_token_files": op4_token_files,
    "op5_multi_index_hashing": op5_multi_index_hashing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_revisits": op7_revisits,
    "op8_quality_rules": op8_quality_rules,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_language_id": op11_language_id,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_cover_tree_negatives": op13_cover_tree_negatives,
}

LLM_ORACLES = {
    "op7_revisits": revisits_sql(),
    "op8_quality_rules": quality_sql(),
    "op10_chat_formatting": chat_sql(),
    "op12_merkle_manifest": merkle_sql(),
    "op13_cover_tree_negatives": negatives_sql(),
}
