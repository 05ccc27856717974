"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from hexloom.llm import (
    dedup,
    fingerprint,
    language,
    licenses,
    lines,
    mixing,
    pieces,
    quality,
    ranking,
    spelling,
    tokencount,
    topk,
    toxicity,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_fingerprint": fingerprint.op2_fingerprint,
    "op3_near_dedup": dedup.op3_near_dedup,
    "op4_quality": quality.op4_quality,
    "op5_language": language.op5_language,
    "op6_token_counts": tokencount.op6_token_counts,
    "op7_mixing": mixing.op7_mixing,
    "op8_licenses": licenses.op8_licenses,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op10_topk": topk.op10_topk,
    "op11_line_dedup": lines.op11_line_dedup,
    "op12_spelling": spelling.op12_spelling,
    "op13_ranked_search": ranking.op13_ranked_search,
}


def sql() -> dict[str, str]:
    """Statements of the queries that SQL can express."""
    return {"op3_near_dedup": dedup.SQL, "op7_mixing": mixing.SQL, "op8_licenses": licenses.SQL, "op10_topk": topk.SQL,
            "op11_line_dedup": lines.SQL, "op12_spelling": spelling.SQL,
            "op13_ranked_search": ranking.SQL}
