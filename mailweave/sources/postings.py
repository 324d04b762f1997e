"""Keyword index as plain tables: postings, term dictionary, field statistics, exact values."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.functions.text import extract_alias, parse_date, term_counts, tokens
from mailweave.session import brief_shuffles, scratch_path

# Index field to mail column.
FIELDS = {
    "subject": "ExtractedSubject",
    "body": "ExtractedBodyText",
    "sender": "ExtractedFrom",
}

# Fields that are found by their whole value, without analysis.
EXACT = {"recipients": "ExtractedTo", "cc": "ExtractedCc"}
EXACT_SCHEMA = "folder string, field string, value string, Id bigint, date_sent timestamp_ntz"
EXACT_PER_FILE = 2_000_000

MAILS_PER_SHARD = 2_000  # a search holds the sums of a bucket, one per query and mail, in one task
MAX_SHARDS = 50_000  # Spark allows 100,000 buckets; beyond this many, buckets grow instead
RUN_TOKENS = 1_000_000  # words counted and sorted at once, of one mail at least
RUN_ROWS = 50_000  # postings handed back at once


@dataclass(frozen=True)
class Index:
    """``postings(folder, field, term, Id, tf, len, date_sent)``,
    ``terms(folder, field, term, df)``, ``fields(folder, field, n_docs, avg_len)`` and
    ``exact(folder, field, value, Id, date_sent)``.
    """

    postings: DataFrame
    terms: DataFrame
    fields: DataFrame
    exact: DataFrame | None = None


def _date_of(corpus: DataFrame) -> Column:
    if "date_sent" in corpus.columns:
        return F.col("date_sent")
    if "ExtractedDateSent" in corpus.columns:
        return parse_date(F.col("ExtractedDateSent"))
    raise ValueError("a keyword index needs date_sent or ExtractedDateSent")


def exact_values(corpus: DataFrame, fields: dict[str, str] | None = None, key: str = "Id") -> DataFrame:
    """``(folder, field, value, Id, date_sent)``: the whole values of a mail, each once.

    Fields are those of ``fields`` that the corpus has (text, or an array of texts), the sender's
    alias as ``sender`` and the date in ISO form as ``date_sent``. Nulls have no row. A narrow
    transformation: no shuffle.
    """
    date = _date_of(corpus)
    parts = []
    for field, column in (fields or EXACT).items():
        if column in corpus.columns:
            whole = isinstance(corpus.schema[column].dataType, T.ArrayType)
            parts.append((field, F.col(column) if whole else F.array(F.col(column).cast("string"))))
    if "ExtractedFrom" in corpus.columns:
        alias = F.when(F.col("ExtractedFrom").isNotNull(), extract_alias(F.col("ExtractedFrom")))
        parts.append(("sender", F.array(alias)))
    parts.append(("date_sent", F.array(F.date_format("date_sent", "yyyy-MM-dd'T'HH:mm:ss"))))
    named = lambda field: lambda value: F.struct(F.lit(field).alias("field"), value.alias("value"))
    pairs = [F.transform(F.array_distinct(values), named(field)) for field, values in parts]
    none = F.array().cast("array<struct<field:string,value:string>>")
    found = F.explode(F.concat(*[F.coalesce(p, none) for p in pairs])).alias("e")
    rows = corpus.withColumn("date_sent", date).select("folder", F.col(key).cast("bigint").alias("Id"), "date_sent", found)
    return rows.select("folder", "e.field", "e.value", "Id", "date_sent").filter(F.col("value").isNotNull())


def _postings(corpus: DataFrame, fields: dict[str, str], key: str) -> DataFrame:
    """One row per term of a field of a mail. A narrow transformation: no shuffle."""
    date = _date_of(corpus)
    texts = F.explode(
        F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).alias("text")) for f, c in fields.items()])
    )
    return (
        corpus.select("folder", F.col(key).alias("Id"), date.alias("date_sent"), texts.alias("t"))
        .select(
            "folder",
            "Id",
            "date_sent",
            F.col("t.field").alias("field"),
            F.explode(term_counts(F.col("t.text"))).alias("e"),
        )
        .select(
            "folder",
            "field",
            F.col("e.term").alias("term"),
            "Id",
            F.col("e.tf").alias("tf"),
            F.col("e.len").alias("len"),
            F.col("e.head").alias("head"),
            "date_sent",
        )
    )


def _postings_in_runs(
    corpus: DataFrame, fields: dict[str, str], key: str, run_tokens: int = RUN_TOKENS, run_rows: int = RUN_ROWS
) -> DataFrame:
    """The rows of :func:`_postings` for writing, in long runs sorted by folder, field and term.

    Spark finds the words. Those of many mails are counted and sorted together as numbers, their places in
    the sorted words, so that the sort before the write only has a few runs to merge. Narrow too.
    """
    names = sorted(fields)
    words = [tokens(F.col(fields[name])).alias(f"_words{i}") for i, name in enumerate(names)]
    source = corpus.select("folder", F.col(key).alias("Id"), _date_of(corpus).alias("date_sent"), *words)
    kinds = {f.name: f.dataType for f in source.schema.fields}
    kinds |= {"field": T.StringType(), "term": T.StringType(), "tf": T.IntegerType(), "len": T.IntegerType(), "head": T.BooleanType()}
    columns = ["folder", "field", "term", "Id", "tf", "len", "head", "date_sent"]

    def lists(batch: pa.RecordBatch) -> list[pa.Array]:
        return [batch.column(f"_words{i}") for i in range(len(names))]

    def lengths(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists(batch)]).astype(np.int64)

    def one_run(mails: pa.RecordBatch) -> pa.RecordBatch:
        n, sizes = mails.num_rows, lengths(mails)
        found = pa.concat_arrays([x.flatten() for x in lists(mails)]).dictionary_encode()
        order = pc.sort_indices(found.dictionary)
        place = np.empty(len(order), dtype=np.int64)
        place[order.to_numpy()] = np.arange(len(order))
        folders = mails.column("folder").to_pylist()
        in_order = {name: i for i, name in enumerate(sorted(set(folders), key=lambda x: (x is not None, x or "")))}
        group = np.array([in_order[x] for x in folders], dtype=np.int64) * len(names) + np.arange(len(names))[:, None]
        at = np.repeat(np.tile(np.arange(n), len(names)), sizes.ravel())
        keys = (np.repeat(group.ravel(), sizes.ravel()) * len(order) + place[found.indices.to_numpy()]) * n + at
        keys, tf = np.unique(keys, return_counts=True)
        row, term = keys % n, keys // n % len(order)
        field = keys // n // len(order) % len(names)
        head = np.zeros(len(keys), dtype=bool)
        head[np.unique(field * n + row, return_index=True)[1]] = True
        made = {
            "field": pa.array(names, pa.string()).take(pa.array(field)),
            "term": found.dictionary.take(order).take(pa.array(term)),
            "tf": pa.array(tf.astype(np.int32)),
            "len": pa.array(sizes[field, row].astype(np.int32)),
            "head": pa.array(head),
        }
        rows = pa.array(row)
        return pa.RecordBatch.from_arrays([made[c] if c in made else mails.column(c).take(rows) for c in columns], names=columns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, start = np.cumsum(lengths(batch).sum(axis=0)), 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + run_tokens, side="right")))
                if ends[stop - 1] > before:
                    run = one_run(batch.slice(start, stop - start))
                    for i in range(0, run.num_rows, run_rows):
                        yield run.slice(i, run_rows)
                start = stop

    return source.mapInArrow(count, T.StructType([T.StructField(c, kinds[c]) for c in columns]))


def corpus_stats(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Document frequency per term; mail count and average length per field.

    One posting of each text is its head and knows the text's length, so the fields follow from
    the heads alone: only the dictionary shuffles terms, and the postings' text is read for it only.
    """
    terms = postings.groupBy("folder", "field", "term").agg(F.count(F.lit(1)).alias("df"))
    fields = postings.filter("head").groupBy("folder", "field").agg(
        F.count(F.lit(1)).alias("n_docs"), (F.sum("len") / F.count(F.lit(1))).alias("avg_len")
    )
    return terms, fields


def build_postings(
    corpus: DataFrame, fields: dict[str, str] | None = None, key: str = "Id"
) -> Index:
    """Keyword index of a corpus as lazy tables."""
    postings = _postings(corpus, fields or FIELDS, key)
    terms, stats = corpus_stats(postings)
    return Index(postings.drop("head"), terms, stats, exact_values(corpus, key=key))


def write_index(
    corpus: DataFrame,
    path: str,
    fields: dict[str, str] | None = None,
    key: str = "Id",
    shards: int | None = None,
) -> None:
    """Write the index, replacing an older one.

    Postings are bucketed by mail: all terms of a mail lie in one file, sorted by term.
    Scores per mail are then complete inside a task, and only its best hits are shuffled.
    The number of files follows the number of mails unless ``shards`` is given. Exact values lie
    in the order of field, value and date, so that a value is read from few row groups.
    """
    spark = corpus.sparkSession
    if shards is None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = min(max(parts, math.ceil(corpus.count() / MAILS_PER_SHARD)), MAX_SHARDS)
    table = _table_name()
    with brief_shuffles(spark):
        (
            _postings_in_runs(corpus.repartition(shards, key), fields or FIELDS, key)
            .write.format("parquet")
            .bucketBy(shards, "Id")
            .sortBy("folder", "field", "term")
            .option("path", f"{path}/postings")
            .mode("overwrite")
            .saveAsTable(table)
        )
        terms, stats = corpus_stats(spark.table(table))
        terms.write.mode("overwrite").parquet(f"{path}/terms")
        stats.write.mode("overwrite").parquet(f"{path}/fields")
        exact = exact_values(corpus, key=key)
        files = max(1, math.ceil(spark.table(table).agg(F.count_if("head")).first()[0] / EXACT_PER_FILE))
        order = ["folder", "field", "value", "date_sent", "Id"]
        exact.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/exact")
    # An empty index has no files of postings to take the columns from.
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(table).schema)
    layout = spark.range(1).select(F.lit(shards).alias("shards"), F.lit(columns).alias("columns"))
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    spark.sql(f"DROP TABLE {table}")


def _table_name() -> str:
    return f"mailweave_postings_{uuid.uuid4().hex}"


def load_index(spark: SparkSession, path: str) -> Index:
    """Read a written index; a missing path is an error.

    The files are declared as an external bucketed table, so that Spark knows their layout.
    """
    layout = spark.read.parquet(f"{path}/layout").first()
    table = _table_name()
    location = f"{path}/postings".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({layout['columns']}) USING parquet "
        f"CLUSTERED BY (Id) SORTED BY (folder, field, term) INTO {layout['shards']} BUCKETS "
        f"LOCATION '{location}'"
    )
    return Index(
        spark.table(table).drop("head"),
        spark.read.parquet(f"{path}/terms"),
        spark.read.parquet(f"{path}/fields"),
        spark.read.schema(EXACT_SCHEMA).parquet(f"{path}/exact"),
    )


def stored_index(
    corpus: DataFrame, fields: dict[str, str] | None = None, key: str = "Id"
) -> Index:
    """Write the index to the shared folder and read it back."""
    path = scratch_path(corpus.sparkSession, "index")
    write_index(corpus, path, fields, key)
    return load_index(corpus.sparkSession, path)
