"""The registered queries of these operators, and their SQL."""

from __future__ import annotations

from quarterfold.llm import (
    op1_quality, op2_shard, op3_substrings, op4_mix, op5_toxicity, op6_exact, op7_jaccard, op8_html, op9_decontaminate,
    op10_pii, op11_lines, op12_pivots, op13_merkle,
)

QUERIES = {
    "op1_quality": op1_quality.op1_quality,
    "op2_shard": op2_shard.op2_shard,
    "op3_substring_dedup": op3_substrings.op3_substring_dedup,
    "op4_mix": op4_mix.op4_mix,
    "op5_toxicity": op5_toxicity.op5_toxicity,
    "op6_exact_dedup": op6_exact.op6_exact_dedup,
    "op7_jaccard": op7_jaccard.op7_jaccard,
    "op8_html": op8_html.op8_html,
    "op9_decontaminate": op9_decontaminate.op9_decontaminate,
    "op10_pii": op10_pii.op10_pii,
    "op11_lines": op11_lines.op11_lines,
    "op12_pivots": op12_pivots.op12_pivots,
    "op13_merkle": op13_merkle.op13_merkle,
}

SQL = {
    "op3_substring_dedup": op3_substrings.SQL,
    "op4_mix": op4_mix.SQL,
    "op6_exact_dedup": op6_exact.SQL,
    "op7_jaccard": op7_jaccard.SQL,
    "op9_decontaminate": op9_decontaminate.SQL,
    "op11_lines": op11_lines.SQL,
    "op12_pivots": op12_pivots.SQL,
    "op13_merkle": op13_merkle.SQL,
}
