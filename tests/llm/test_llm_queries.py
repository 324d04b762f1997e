"""The registered queries on the smallest tables, and the pipeline."""

import re

import duckdb
import pytest

import corpus_pipeline
from mailweave.llm import registry

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id start n_tokens ids_crc32",
    "op2": "doc_id held_out lang_pred score",
    "op3": "doc_id held_out score predicted",
    "op4": "doc_id n_shingles component_id",
    "op5": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6": "doc_id size source_size target taken",
    "op7": "vec_id n_links component_id kept",
    "op8": "doc_id size text_crc32 law shard slot grown_shard",
    "op9": "page_id url text n_chars",
    "op10": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op11": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op13": "page_id payload_bytes payload_digest record_type refers_to",
}


@pytest.mark.parametrize("name", [n for n in registry.queries() if n != "pipeline"])
def test_columns_and_rows(spark, name):
    found = registry.queries()[name](spark, SF)
    number = name.split("_")[0]
    want = COLUMNS[number].split()
    assert found.columns[: len(want)] == want
    if number == "op12":
        assert found.count() == 600 * spark.read.parquet(f"{SF}/documents.parquet").select("lang").distinct().count()
        return
    table = {"op7": "embeddings", "op9": "pages", "op13": "pages"}.get(number, "documents")
    assert found.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", [*registry.oracle_sql()])
def test_equal_to_sql(spark, name):
    found = registry.queries()[name](spark, SF)
    for table in ("documents", "labels", "pages"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = duckdb.sql(registry.oracle_sql()[name])
    places = [found.columns.index(c) for c in want.columns]
    assert len(places) == len(found.columns)
    rows = [tuple(r[k] for k in places) for r in found.collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)


def test_native_queries_run_no_python(spark):
    for name in ("op6_mix_sources", "op10_quality_rules"):
        plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|MapIn", plan)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        before = out.count()
        out = stage(spark, out, SF)
        if name != "encode_tokens":
            assert out.columns == columns
        if name not in ("mix_sources",):
            assert out.count() <= before
    assert {"doc_id", "n_tokens", "ids"} <= {*out.columns} and out.count() > 0
    # Decisions take effect: clean documents stay, junk goes.
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = corpus_pipeline.filter_quality(spark, docs, SF).join(labels, "doc_id")
    share = {r.quality: r["count"] for r in good.groupBy("quality").count().collect()}
    total = {r.quality: r["count"] for r in docs.join(labels, "doc_id").groupBy("quality").count().collect()}
    assert share[1] >= 0.97 * total[1] and share.get(0, 0) <= 0.3 * total[0]
