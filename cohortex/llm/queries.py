"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from cohortex.llm import ann, conversation_repair, exact_dedup, hard_negatives, html_extract, katz, language_id, mixing, near_join, packing, substring_dedup, toxicity, warc

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_katz": katz.op2_katz,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_mixing": mixing.op4_mixing,
    "op5_html_extraction": html_extract.op5_html_extraction,
    "op6_ann": ann.op6_ann,
    "op7_near_join": near_join.op7_near_join,
    "op8_warc": warc.op8_warc,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_substring_dedup": substring_dedup.op13_substring_dedup,
}

ORACLE = {
    "op4_mixing": mixing.SQL,
    "op7_near_join": near_join.SQL,
    "op8_warc": warc.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op11_conversation_repair": conversation_repair.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_substring_dedup": substring_dedup.SQL,
}
