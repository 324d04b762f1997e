"""Sender lookup, folder split, recipients and deduplication of raw mail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from mailweave.functions.text import extract_alias, is_owner
from mailweave.operators.joins import attach

# The columns of a mailbox table.
MAILBOX_COLUMNS = [
    "Id",
    "ExtractedSubject",
    "ExtractedBodyText",
    "ExtractedFrom",
    "ExtractedTo",
    "ExtractedCc",
    "ExtractedDateSent",
]
FOLDERS = ("inbox", "sent")


def alias_people(aliases: DataFrame, persons: DataFrame) -> DataFrame:
    """``(Alias, PersonId, Name, ord)`` with the alias in lower case."""
    people = persons.select(F.col("Id").alias("PersonId"), "Name")
    joined = attach(aliases, people, ["PersonId"], ["ord"], "inner")
    return joined.select(F.lower("Alias").alias("Alias"), "PersonId", "Name", "ord")


def alias_names(aliases: DataFrame, persons: DataFrame) -> DataFrame:
    """``(Alias, Name)``: the last row of an alias wins."""
    people = alias_people(aliases, persons).filter(F.col("Alias").isNotNull())
    return people.groupBy("Alias").agg(F.max_by("Name", "ord").alias("Name"))


def name_alias_rows(aliases: DataFrame, persons: DataFrame) -> DataFrame:
    """``(Name, Alias, ord)``, one row per alias of a named person."""
    return (
        alias_people(aliases, persons)
        .filter(F.col("Name").isNotNull())
        .select("Name", "Alias", "ord")
    )


def name_aliases(aliases: DataFrame, persons: DataFrame) -> DataFrame:
    """``(Name, aliases)``: all aliases of a name in row order; equal names merge."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "Alias")))
    return (
        name_alias_rows(aliases, persons)
        .groupBy("Name")
        .agg(F.transform(ordered, lambda x: x["Alias"]).alias("aliases"))
    )


def fill_sender(emails: DataFrame) -> DataFrame:
    """Replace a missing sender by its cleaned alias."""
    return emails.withColumn("ExtractedFrom", F.coalesce("ExtractedFrom", "CleanedAlias"))


def with_senders(emails: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``CleanedAlias`` and ``SenderName``; mails of one sender may be very many."""
    aliased = emails.withColumn("CleanedAlias", extract_alias(F.col("ExtractedFrom")))
    lookup = names.select(F.col("Alias").alias("CleanedAlias"), F.col("Name").alias("SenderName"))
    return attach(aliased, lookup, ["CleanedAlias"], ["Id"])


def owner_aliases(aliases: DataFrame, persons: DataFrame, pattern: str) -> DataFrame:
    """Distinct aliases of all persons whose name matches the owner pattern."""
    people = alias_people(aliases, persons)
    return people.filter(is_owner(F.col("Name"), pattern)).select("Alias").distinct()


def flag_sent(emails: DataFrame, owners: DataFrame) -> DataFrame:
    """Add ``IsOwnerSender``, true when the cleaned alias belongs to the owner."""
    flags = owners.select(F.col("Alias").alias("CleanedAlias"), F.lit(True).alias("_own"))
    flagged = attach(emails, flags, ["CleanedAlias"], ["Id"])
    return flagged.withColumn("IsOwnerSender", F.coalesce("_own", F.lit(False))).drop("_own")


def received_ids(receivers: DataFrame, persons: DataFrame, pattern: str) -> DataFrame:
    """Distinct ``Id`` of mails with the owner among the receivers."""
    owners = persons.filter(is_owner(F.col("Name"), pattern)).select(F.col("Id").alias("PersonId"))
    mine = attach(receivers, owners.distinct(), ["PersonId"], ["EmailId"], "left_semi")
    return mine.select(F.col("EmailId").alias("Id")).distinct()


def inbox_mails(
    emails: DataFrame, receivers: DataFrame, persons: DataFrame, pattern: str
) -> DataFrame:
    """Mails the owner received."""
    received = received_ids(receivers, persons, pattern)
    return attach(emails, received, ["Id"], ["Id"], "left_semi", unique=True)


def sent_mails(
    emails: DataFrame, aliases: DataFrame, persons: DataFrame, pattern: str
) -> DataFrame:
    """Mails sent from an alias of the owner."""
    aliased = emails.withColumn("CleanedAlias", extract_alias(F.col("ExtractedFrom")))
    owners = owner_aliases(aliases, persons, pattern).withColumnRenamed("Alias", "CleanedAlias")
    return attach(aliased, owners, ["CleanedAlias"], ["Id"], "left_semi")


def recipient_rows(receivers: DataFrame, persons: DataFrame) -> DataFrame:
    """``(EmailId, PersonId, ord, Name)`` for receivers that are known persons."""
    people = persons.select(F.col("Id").alias("PersonId"), "Name")
    joined = attach(receivers, people, ["PersonId"], ["EmailId"], "inner")
    return joined.select("EmailId", "PersonId", "ord", "Name")


def recipients(receivers: DataFrame, persons: DataFrame) -> DataFrame:
    """``(EmailId, ExtractedTo)``: names of the receivers of a mail in row order."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "Name")))
    return (
        recipient_rows(receivers, persons)
        .groupBy("EmailId")
        .agg(F.transform(ordered, lambda x: x["Name"]).alias("ExtractedTo"))
    )


def with_recipients(emails: DataFrame, lists: DataFrame) -> DataFrame:
    """Overwrite ``ExtractedTo``; null when a mail has no known receiver."""
    lists = lists.withColumnRenamed("EmailId", "Id")
    return attach(emails.drop("ExtractedTo"), lists, ["Id"], ["Id"], unique=True)


def drop_empty_body(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ExtractedBodyText").isNotNull())


def _copies(df: DataFrame, order_col: str | None) -> WindowSpec:
    order = [F.when(F.col("folder") == FOLDERS[0], 0).otherwise(1)]
    order += [F.col(order_col)] if order_col else [F.xxhash64(*df.columns)]
    return Window.partitionBy("Id").orderBy(*order)


def dedupe_corpus(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per ``Id``, inbox before sent; copies are cut in each task before the shuffle."""
    return df.withColumn("_n", F.row_number().over(_copies(df, order_col))).filter("_n = 1").drop("_n")


def mark_leads(df: DataFrame, name: str, order_col: str | None = None) -> DataFrame:
    """Add ``name``, true for the row of an ``Id`` that :func:`dedupe_corpus` keeps."""
    return df.withColumn(name, F.row_number().over(_copies(df, order_col)) == 1)


def mailbox_stats(mailboxes: DataFrame) -> DataFrame:
    """Number of mails per folder."""
    return mailboxes.groupBy("folder").agg(F.count(F.lit(1)).alias("n_mails"))
