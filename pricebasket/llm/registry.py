"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pricebasket.llm import (bpe, html_text, importance, language_id, line_dedup, lm_scoring, mixing, quality, simhash,
                             token_align, toxicity, vector_search, warc)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_simhash": simhash.op2_simhash,
    "op3_bpe": bpe.op3_bpe,
    "op4_lm_scoring": lm_scoring.op4_lm_scoring,
    "op5_warc": warc.op5_warc,
    "op6_language_id": language_id.op6_language_id,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_quality": quality.op8_quality,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_vector_search": vector_search.op10_vector_search,
    "op11_html_text": html_text.op11_html_text,
    "op12_importance": importance.op12_importance,
    "op13_token_align": token_align.op13_token_align,
}

ORACLES = {
    "op1_mixing": mixing.ORACLE_OP1,
    "op5_warc": warc.ORACLE_OP5,
    "op9_line_dedup": line_dedup.ORACLE_OP9,
    "op10_vector_search": vector_search.ORACLE_OP10,
}
