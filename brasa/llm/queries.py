"""Registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from . import (decontaminate, epsilon_join, hard_negatives, html_text, line_dedup, mixing, pii, quality, secrets, simhash,
               spelling, suffix_dedup, warc)

SPARK = {
    "op1_suffix_dedup": suffix_dedup.query,
    "op2_quality_rules": quality.query,
    "op3_personal_data": pii.query,
    "op4_warc_fixity": warc.query,
    "op5_source_mixing": mixing.query,
    "op6_html_text": html_text.query,
    "op7_line_dedup": line_dedup.query,
    "op8_simhash": simhash.query,
    "op9_secrets": secrets.query,
    "op10_decontamination": decontaminate.query,
    "op11_spelling_variants": spelling.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_embedding_dedup": epsilon_join.query,
    "pipeline": corpus_pipeline.run,
}

#: Operators without an entry are held against brute-force versions in tests/llm.
ORACLE = {
    "op2_quality_rules": quality.oracle(),
    "op4_warc_fixity": warc.oracle(),
    "op5_source_mixing": mixing.oracle(),
    "op7_line_dedup": line_dedup.oracle(),
    "op9_secrets": secrets.oracle(),
    "op12_hard_negatives": hard_negatives.oracle(),
    "op13_embedding_dedup": epsilon_join.oracle(),
}
