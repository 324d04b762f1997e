"""Text reports of ranked mails, one block of text per row."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.operators.ranking import rank_within

# Wording and lengths of the report.
QUERY_TITLE = "\n~~~~~~~~~~~~ QUERY #%d ~~~~~~~~~~~~\n"
SET_TITLE = "\n~~~~~~~~~~~~ QUERY SET #%d ~~~~~~~~~~~~\n"
SET_LEAD = "Top 4 distinct results across queries: \n"
RULE = "______________________\n"
NO_SUBJECT = "No Subject"
NO_BODY = "[No Body Content]"
SUBJECT_CHARS = 80
BODY_CHARS = 1000
PART = "part"  # names the directories of a report


def _text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit("None"))


def _preview(name: str, default: str, chars: int) -> Column:
    filled = F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default))
    return F.substring(filled, 1, chars)


def _result(to: Column) -> Column:
    """One result: sender for the inbox, recipients for the sent folder."""
    party = F.when(
        F.col("folder") == "inbox", F.concat(F.lit("From: "), _text(F.col("ExtractedFrom")))
    ).otherwise(F.concat(F.lit("To: "), to))
    return F.concat(
        F.format_string("Result %d\n", F.col("rank") + 1),
        F.lit(RULE),
        F.format_string("Email ID: %d\n", F.col("Id")),
        party,
        F.lit("\nCC'd: "),
        _text(F.col("ExtractedCc")),
        F.lit("\nDate: "),
        _text(F.col("ExtractedDateSent")),
        F.lit("\nSubject: "),
        _preview("ExtractedSubject", NO_SUBJECT, SUBJECT_CHARS),
        F.lit("\nBody Preview: "),
        _preview("ExtractedBodyText", NO_BODY, BODY_CHARS),
        F.lit("\n\n"),
    )


def _recipients(mails: DataFrame) -> Column:
    kind = mails.schema["ExtractedTo"].dataType.typeName()
    to = F.array_join("ExtractedTo", ", ") if kind == "array" else F.col("ExtractedTo")
    return _text(to)


def format_results(mails: DataFrame, queries: DataFrame) -> DataFrame:
    """``(folder, qid, rank, text)``: a heading per query (rank -1), then its results."""
    results = mails.select("folder", "qid", "rank", _result(_recipients(mails)).alias("text"))
    heads = mails.select("folder", "qid").distinct().join(queries.select("qid", "query"), "qid")
    heading = F.concat(
        F.format_string(QUERY_TITLE, F.col("qid")),
        F.format_string("Folder: %s\nQuery: %s\n\n", F.col("folder"), F.col("query")),
    )
    return results.unionByName(
        heads.select("folder", "qid", F.lit(-1).cast("bigint").alias("rank"), heading.alias("text"))
    )


def format_set_results(best: DataFrame, queries: DataFrame) -> DataFrame:
    """``(folder, set_id, rank, text)``: the queries of a set (rank -1), then its best mails."""
    results = best.select("folder", "set_id", "rank", _result(_recipients(best)).alias("text"))
    ordered = F.array_sort(F.collect_list(F.struct("qid", "query")))
    lines = F.transform(
        ordered, lambda q, i: F.format_string("Query %d: %s\n", i + 1, q["query"])
    )
    listed = queries.groupBy("set_id").agg(F.array_join(lines, "").alias("lines"))
    heads = best.select("folder", "set_id").distinct().join(listed, "set_id")
    heading = F.concat(
        F.format_string(SET_TITLE, F.col("set_id")),
        F.format_string("Folder: %s\n", F.col("folder")),
        F.col("lines"),
        F.lit(SET_LEAD),
    )
    return results.unionByName(
        heads.select("folder", "set_id", F.lit(-1).cast("bigint").alias("rank"), heading.alias("text"))
    )


def write_report(report: DataFrame, path: str, mode: str = "append") -> int:
    """Write report blocks as text in reading order; returns the number of this part of the report.

    A report is a sequence of parts, each a directory of its own that carries its number. A part is
    there as a whole or not at all: Spark moves its files into place when all tasks are done, and a
    number that another writer took first is left to it. ``overwrite`` starts a new report: the
    older parts go when the new one is complete.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    group = "set_id" if "set_id" in report.columns else "qid"
    blocks = report.orderBy("folder", group, "rank").select("text")
    before = _parts(report.sparkSession, path)
    number = max(before, default=0) + 1
    while True:
        try:
            blocks.write.mode("errorifexists").text(f"{path}/{PART}={number:09d}")
            break
        except AnalysisException as taken:
            if taken.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            number += 1
    if mode == "overwrite":
        for old in before:
            _file_system(report.sparkSession, path).delete(_hadoop_path(report.sparkSession, f"{path}/{PART}={old:09d}"), True)
    return number


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, line)``: the lines of all parts in the order in which they were written."""
    lines = spark.read.text(path).select(
        F.col(PART).cast("bigint").alias("part"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    order = [F.col(c).asc() for c in ("part", "file", "start", "row")]
    ranked = rank_within(lines.withColumn("report", F.lit(0)), ["report"], order, "line_no")
    return ranked.select("line_no", "line")


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _parts(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the parts at ``path``, complete or not."""
    files, place = _file_system(spark, path), _hadoop_path(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(name.partition("=")[2]) for name in names if name.startswith(f"{PART}="))
