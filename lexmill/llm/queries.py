"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import op1_ann, op2_bpe, op3_lines, op4_tokenfile, op5_toxicity, op6_jaccard, op7_html, op8_licenses, op9_decontaminate, op10_quality, op11_turns, op12_centroids, op13_minhash, sql

QUERIES = {
    "op1_ann": op1_ann.query,
    "op2_bpe": op2_bpe.query,
    "op3_lines": op3_lines.query,
    "op4_tokenfile": op4_tokenfile.query,
    "op5_toxicity": op5_toxicity.query,
    "op6_jaccard": op6_jaccard.query,
    "op7_html": op7_html.query,
    "op8_licenses": op8_licenses.query,
    "op9_decontaminate": op9_decontaminate.query,
    "op10_quality": op10_quality.query,
    "op11_turns": op11_turns.query,
    "op12_centroids": op12_centroids.query,
    "op13_minhash": op13_minhash.query,
}

ORACLE_SQL = {
    "op6_jaccard": sql.similar_groups(5, 80),
    "op8_licenses": op8_licenses.SQL,
    "op9_decontaminate": sql.decontamination(),
    "op11_turns": sql.repairs(),
    "op12_centroids": sql.clusters(),
    "op13_minhash": sql.similar_groups(3, 85, ", component_id = d.doc_id AS kept"),
}
