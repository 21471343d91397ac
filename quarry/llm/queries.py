"""The subpackage's queries, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from quarry.llm import byte_bpe, decontam, langid, licenses, line_dedup, quality, shard_tree, simhash, suffix_dedup, token_counts

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.query,
    "op2_sharding": shard_tree.query,
    "op3_licenses": licenses.query,
    "op4_language_id": langid.query,
    "op5_byte_bpe": byte_bpe.query,
    "op6_token_counts": token_counts.query,
    "op7_quality_rules": quality.query,
    "op8_decontamination": decontam.query,
    "op9_simhash": simhash.query,
    "op10_line_dedup": line_dedup.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op3_licenses": licenses.SQL,
    "op8_decontamination": decontam.SQL,
    "op10_line_dedup": line_dedup.SQL,
}
