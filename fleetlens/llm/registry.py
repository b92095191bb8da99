"""The subpackage's queries (name -> callable) and the DuckDB SQL of those SQL can express."""

from __future__ import annotations

from fleetlens.llm import (
    filter_audit,
    fingerprint_cth,
    html_lstm,
    packing,
    pii_weak,
    quality_bt,
    quality_rules,
    sampled_pieces,
    secrets_owners,
    simhash_gph,
    spelling_pivots,
    toxicity_knn,
    warc_archive,
)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_sampled_pieces": sampled_pieces.query,
    "op3_main_text": html_lstm.query,
    "op4_secrets": secrets_owners.query,
    "op5_packing": packing.query,
    "op6_toxicity": toxicity_knn.query,
    "op7_pii": pii_weak.query,
    "op8_fingerprint": fingerprint_cth.query,
    "op9_quality": quality_bt.query,
    "op10_simhash": simhash_gph.query,
    "op11_spelling": spelling_pivots.query,
    "op12_filter_audit": filter_audit.query,
    "op13_warc": warc_archive.query,
}

ORACLE_SQL = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op4_secrets": secrets_owners.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_warc": warc_archive.ORACLE,
}
