"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from meshwork.llm import exact_dedup, html_extract, langid, media, packing, pieces, quality, simhash, toxicity, urls

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_media": media.op2_media,
    "op3_quality": quality.op3_quality,
    "op4_language": langid.op4_language,
    "op5_url_filter": urls.op5_url_filter,
    "op6_html_text": html_extract.op6_html_text,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_packing": packing.op9_packing,
    "op10_pieces": pieces.op10_pieces,
}

ORACLE_SQL = {"op8_exact_dedup": exact_dedup.OP8_SQL}
