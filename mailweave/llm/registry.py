"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from functools import wraps

import corpus_pipeline
from mailweave.llm import (
    bpe, fill_in_middle, filter_audit, html_text, language_id, mil_quality, mix, ngram_join, quality_rules, shards, token_files,
    vector_join, warc,
)
from mailweave.llm.common import small_batches
from mailweave.session import ship

QUERIES = {
    "op1_token_files": token_files.op1_token_files,
    "op2_language_id": language_id.op2_language_id,
    "op3_quality": mil_quality.op3_quality,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_bpe_round_trip": bpe.op5_bpe_round_trip,
    "op6_mix_sources": mix.op6_mix_sources,
    "op7_vector_join": vector_join.op7_vector_join,
    "op8_shards": shards.op8_shards,
    "op9_html_text": html_text.op9_html_text,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_warc": warc.op13_warc,
}
SQL = {
    "op6_mix_sources": mix.ORACLE_SQL,
    "op10_quality_rules": quality_rules.ORACLE_SQL,
    "op11_fill_in_middle": fill_in_middle.ORACLE_SQL,
    "op12_filter_audit": filter_audit.ORACLE_SQL,
    "op13_warc": warc.ORACLE_SQL,
}


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        small_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    return {name: _shipped(query) for name, query in (QUERIES | {"pipeline": corpus_pipeline.run}).items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
