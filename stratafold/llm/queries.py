"""The registered queries of this subpackage and, where SQL can express one, its DuckDB twin."""

from __future__ import annotations

from . import crossentropy, html, lines, media, mixing, multiset, pieces, simhash, substrings, toxicity

QUERIES = {
    "op1_simhash_near_dedup": simhash.op1,
    "op2_toxicity": toxicity.op2,
    "op3_html_text": html.op3,
    "op4_cross_entropy": crossentropy.op4,
    "op5_source_mixing": mixing.op5,
    "op6_line_dedup": lines.op6,
    "op7_suffix_array_dedup": substrings.op7,
    "op8_progressive_jpeg": media.op8,
    "op9_sentencepiece": pieces.op9,
    "op10_multiset_fingerprint": multiset.op10,
}
ORACLE_SQL = {"op5_source_mixing": mixing.OP5_SQL, "op6_line_dedup": lines.OP6_SQL}
