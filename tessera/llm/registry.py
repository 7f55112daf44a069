"""Queries of this package and their DuckDB SQL."""

from __future__ import annotations

from tessera.llm import (language, licences, mixing, near_dup, negatives, passages, pieces, pii, quality, secrets,
                         simhash, topk, whitening)

QUERIES = {
    "op1_passages": passages.op1_passages,
    "op2_language": language.op2_language,
    "op3_pii": pii.op3_pii,
    "op4_topk": topk.op4_topk,
    "op5_pieces": pieces.op5_pieces,
    "op6_licences": licences.op6_licences,
    "op7_quality": quality.op7_quality,
    "op8_mixing": mixing.op8_mixing,
    "op9_near_dup": near_dup.op9_near_dup,
    "op10_simhash": simhash.op10_simhash,
    "op11_whitening": whitening.op11_whitening,
    "op12_secrets": secrets.op12_secrets,
    "op13_negatives": negatives.op13_negatives,
}

ORACLE = {
    "op4_topk": topk.OP4_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op13_negatives": negatives.OP13_SQL,
}
