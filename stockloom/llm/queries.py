"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from stockloom.llm import op3_urls, sql
from stockloom.llm import op13_warc as warc
from stockloom.llm.op1_html import op1_html_extraction
from stockloom.llm.op2_fingerprint import op2_fingerprint
from stockloom.llm.op3_urls import op3_url_filter
from stockloom.llm.op4_packing import op4_packing
from stockloom.llm.op5_quality import op5_quality
from stockloom.llm.op6_lines import op6_line_dedup
from stockloom.llm.op7_embeddings import op7_embedding_join
from stockloom.llm.op8_jaccard import op8_jaccard_join
from stockloom.llm.op9_bpe import op9_bpe_encode_decode
from stockloom.llm.op10_language import op10_language_id
from stockloom.llm.op11_spelling import op11_spelling_variants
from stockloom.llm.op12_alignment import op12_token_alignment
from stockloom.llm.op13_warc import op13_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_fingerprint,
        op3_url_filter,
        op4_packing,
        op5_quality,
        op6_line_dedup,
        op7_embedding_join,
        op8_jaccard_join,
        op9_bpe_encode_decode,
        op10_language_id,
        op11_spelling_variants,
        op12_token_alignment,
        op13_warc,
    )
}

ORACLE: dict[str, str] = {
    "op3_url_filter": op3_urls.SQL,
    "op6_line_dedup": sql.LINE_DEDUP,
    "op7_embedding_join": sql.EMBEDDING_JOIN,
    "op8_jaccard_join": sql.JACCARD_JOIN,
    "op13_warc": warc.SQL,
}
