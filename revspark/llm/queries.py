"""Queries of this package and their DuckDB SQL, by registered name."""
from __future__ import annotations

from . import (op1_substring_dedup, op2_html_text, op3_exact_dedup, op4_token_counts, op5_quality, op6_language_id,
               op7_decontaminate, op8_bpe, op9_suffix_array, op10_near_dedup, op11_merkle, op12_alignment, op13_mixing)

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup.op1_substring_dedup,
    "op2_html_text": op2_html_text.op2_html_text,
    "op3_exact_dedup": op3_exact_dedup.op3_exact_dedup,
    "op4_token_counts": op4_token_counts.op4_token_counts,
    "op5_quality": op5_quality.op5_quality,
    "op6_language_id": op6_language_id.op6_language_id,
    "op7_decontaminate": op7_decontaminate.op7_decontaminate,
    "op8_bpe": op8_bpe.op8_bpe,
    "op9_suffix_array": op9_suffix_array.op9_suffix_array,
    "op10_near_dedup": op10_near_dedup.op10_near_dedup,
    "op11_merkle": op11_merkle.op11_merkle,
    "op12_alignment": op12_alignment.op12_alignment,
    "op13_mixing": op13_mixing.op13_mixing,
}
ORACLES = {"op3_exact_dedup": op3_exact_dedup.ORACLE_SQL, "op13_mixing": op13_mixing.ORACLE_SQL}
