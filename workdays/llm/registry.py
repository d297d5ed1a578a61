"""Queries of this subpackage, their SQL where it can express them, and the pipeline."""

from __future__ import annotations

import corpus_pipeline

from . import (
    chat,
    decontaminate,
    exact_dedup,
    fill_middle,
    fingerprints,
    language,
    mixing,
    near_dedup,
    pieces,
    repair,
    secrets,
    token_counts,
    token_files,
)

QUERIES = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_mixing": mixing.op2_mixing,
    "op3_token_files": token_files.op3_token_files,
    "op4_chat_format": chat.op4_chat_format,
    "op5_near_duplicates": near_dedup.op5_near_duplicates,
    "op6_repeated_strings": exact_dedup.op6_repeated_strings,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_language_id": language.op9_language_id,
    "op10_secrets": secrets.op10_secrets,
    "op11_sentencepiece": pieces.op11_sentencepiece,
    "op12_fill_in_middle": fill_middle.op12_fill_in_middle,
    "op13_conversation_repair": repair.op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {"op2_mixing": mixing.OP2_SQL, "op12_fill_in_middle": fill_middle.OP12_SQL}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
