"""The four raw tables as CSV files with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.operators.mailbox import name_alias_rows, name_aliases

# File names and columns of the raw tables.
SCHEMAS = {
    "Emails": (
        "Id bigint, ExtractedSubject string, ExtractedBodyText string, ExtractedFrom string, "
        "ExtractedTo string, ExtractedCc string, ExtractedDateSent string"
    ),
    "EmailReceivers": "EmailId bigint, PersonId bigint",
    "Aliases": "Alias string, PersonId bigint",
    "Persons": "Id bigint, Name string",
}


def read_raw_table(
    spark: SparkSession, directory: str, name: str, multiline: bool = True
) -> DataFrame:
    """One raw table with its row order as ``ord`` (file, place in the file, row); a missing
    path is an error. Files follow each other by name.

    Columns are matched by header name. Bodies hold line breaks, so a file is read by one
    task; a table of many files is read in parallel. ``multiline=False`` splits files.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    path = f"{directory}/{name}.csv"
    wanted = [part.strip().split(" ") for part in SCHEMAS[name].split(",")]
    header = reader.option("enforceSchema", False).option("inferSchema", False).csv(path)
    by_type = {column: kind for column, kind in wanted}
    full = ", ".join(f"`{c}` {by_type.get(c, 'string')}" for c in header.columns)
    rows = reader.schema(full).csv(path)
    missing = [c for c, _ in wanted if c not in rows.columns]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}")
    # Spark reads large splits first, so ids alone do not follow the files.
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select(*[c for c, _ in wanted], place.alias("ord"))


def read_raw(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """All four raw tables by name."""
    return {name: read_raw_table(spark, directory, name) for name in SCHEMAS}


def load_name_aliases(raw: dict[str, DataFrame]) -> DataFrame:
    """``(Name, aliases)`` from the raw tables."""
    return name_aliases(raw["Aliases"], raw["Persons"])


def load_alias_rows(raw: dict[str, DataFrame]) -> DataFrame:
    """``(Name, Alias)``, the long form used for search."""
    return name_alias_rows(raw["Aliases"], raw["Persons"]).drop("ord")
