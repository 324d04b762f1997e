"""From raw documents to token ids: the stages of the corpus pipeline.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written and read again as the
next one's documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.llm import bpe, language_id, mil_quality, mix, ngram_join
from mailweave.llm.common import fresh, small_batches, words
from mailweave.session import ship, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned from the documents themselves."""
    small_batches(spark)
    return language_id.stage(spark, docs, sf_dir)


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of fair quality."""
    small_batches(spark)
    return mil_quality.stage(spark, docs, sf_dir)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    small_batches(spark)
    return ngram_join.stage(spark, docs, sf_dir)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one taken twice stands in two rows."""
    (size,) = fresh(docs, "_size")
    sized = docs.withColumn(size, F.size(words(F.col("text"))).cast("bigint"))
    return mix.emit_copies(mix.systematic_mix(sized, size=size)).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, source, lang, n_tokens, ids)``: ids as little-endian unsigned 32-bit integers."""
    small_batches(spark)
    encoded = bpe.encode_texts(docs.select("doc_id", "source", "lang", "text"))
    return encoded.select(
        "doc_id", "source", "lang", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids"
    )


STAGES = [
    ("identify_language", identify_language),
    ("filter_quality", filter_quality),
    ("drop_near_duplicates", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("encode_tokens", encode_tokens),
]
# Trained models and near-duplicate groups have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
