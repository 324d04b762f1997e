"""Small column helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what separates words.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python a few megabytes at a time: texts are long, and both sides hold a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def words(text: Column) -> Column:
    """The words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, built from ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
