"""Mailbox and vector tables as parquet, partitioned by folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.functions.text import iso_date, parse_date
from mailweave.operators.mailbox import FOLDERS, mark_leads
from mailweave.session import brief_shuffles


def check_folder(folder: str | None) -> None:
    if folder is not None and folder not in FOLDERS:
        raise ValueError(f"folder must be one of {FOLDERS}, not {folder!r}")


BLOCKS = 16
LEADS = "leads"  # marks the row of an Id that a corpus of both folders keeps


def mail_block(mail_id: Column, blocks: int) -> Column:
    """Directory of a mail; it carries the number of blocks it was made with."""
    return F.concat_ws("-", F.lit(blocks), F.pmod(F.xxhash64(mail_id), F.lit(blocks)))


def write_mailbox(
    df: DataFrame, path: str, blocks: int = BLOCKS, order_col: str | None = None
) -> None:
    """Replace the mailbox table at ``path``.

    Mails are grouped into blocks by a hash of their id, so that fetching a few results
    reads few directories. The rebalance lets Spark split a block that is too big for a
    task and join small ones. Use more blocks for larger tables. The row that stands for its
    ``Id`` is marked here, once, so that loading is a plain scan.
    """
    blocked = df.withColumn("block", mail_block(F.col("Id"), blocks))
    marked = mark_leads(blocked, LEADS, order_col).hint("rebalance", "folder", "block")
    with brief_shuffles(df.sparkSession):
        marked.write.mode("overwrite").partitionBy("folder", "block").parquet(path)


def load_corpus(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """Mails of both folders, one row per ``Id``; a mail in both stays in the inbox.

    A folder needs only its own partition. The column ``block`` serves ``fetch``.
    """
    check_folder(folder)
    unique = spark.read.parquet(path).filter(LEADS).drop(LEADS)
    return unique if folder is None else unique.filter(F.col("folder") == folder)


def with_dates(corpus: DataFrame) -> DataFrame:
    """Bring ``ExtractedDateSent`` into ISO form and add ``date_sent`` as a timestamp."""
    return corpus.withColumn("date_sent", parse_date(F.col("ExtractedDateSent"))).withColumn(
        "ExtractedDateSent", iso_date(F.col("ExtractedDateSent"))
    )


def write_vectors(df: DataFrame, path: str) -> None:
    """Replace the vector table ``(folder, Id, embedding)`` at ``path``."""
    vectors = df.select("folder", "Id", F.col("embedding").cast("array<float>").alias("embedding"))
    with brief_shuffles(df.sparkSession):
        vectors.write.mode("overwrite").partitionBy("folder").parquet(path)


def load_vectors(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """Vectors of one folder or of all; a missing path is an error."""
    check_folder(folder)
    vectors = spark.read.parquet(path)
    return vectors if folder is None else vectors.filter(F.col("folder") == folder)
