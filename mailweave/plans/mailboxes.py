"""From raw tables to mailboxes and vector tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.functions.text import clean_body, clean_subject, compose_text, extract_alias, parse_date, repair_date_text
from mailweave.operators import mailbox as mb
from mailweave.operators.encode import Encoder, embed
from mailweave.operators.joins import attach
from mailweave.session import stored


def build_mailboxes(
    raw: dict[str, DataFrame], owner_pattern: str, keep_clean: bool = False
) -> DataFrame:
    """Inbox and sent mails of the owner as one table with ``folder``.

    A mail can be in both folders. Each mail is read once and tagged, not scanned per
    folder; with small lookups only the owner's mails are shuffled, for their recipients. ``keep_clean`` adds the cleaned text, the parsed date and the sender's name.
    """
    emails, receivers = raw["Emails"], raw["EmailReceivers"]
    aliases, persons = raw["Aliases"], raw["Persons"]
    # Names of the senders are only wanted beside the cleaned text.
    mails = emails.withColumn("CleanedAlias", extract_alias(F.col("ExtractedFrom")))
    if keep_clean:
        mails = mb.with_senders(emails, mb.alias_names(aliases, persons))
    mails = mb.flag_sent(mails, mb.owner_aliases(aliases, persons, owner_pattern))
    mails = mb.fill_sender(mails)
    # Both sides are stored, as their size is measured before they are joined.
    received = stored(mb.received_ids(receivers, persons, owner_pattern), "received")
    sent = mails.filter("IsOwnerSender").select("Id")
    kept = stored(received.union(sent).distinct().withColumnRenamed("Id", "EmailId"), "kept_ids")
    mails = attach(mails, received.withColumn("_in", F.lit(True)), ["Id"], ["Id"], unique=True)
    mails = mb.drop_empty_body(mails.filter(F.col("_in") | F.col("IsOwnerSender")))
    # Lists are built for the owner's mails only.
    mine = attach(receivers, kept, ["EmailId"], ["PersonId"], "left_semi")
    mails = mb.with_recipients(mails, stored(mb.recipients(mine, persons), "recipients"))
    folders = F.array_compact(
        F.array(F.when(F.col("_in"), mb.FOLDERS[0]), F.when(F.col("IsOwnerSender"), mb.FOLDERS[1]))
    )
    extra = []
    if keep_clean:
        extra = [
            clean_subject(F.col("ExtractedSubject")).alias("subject"),
            clean_body(F.col("ExtractedBodyText")).alias("body"),
            parse_date(repair_date_text(F.col("ExtractedDateSent"))).alias("date"),
            F.col("CleanedAlias"),
            F.col("SenderName"),
        ]
    return mails.select(*mb.MAILBOX_COLUMNS, *extra, F.explode(folders).alias("folder"))


def build_vectors(
    corpus: DataFrame,
    encoder: Callable[[], Encoder] | None = None,
    batch_size: int = 32,
    dim: int = 64,
) -> DataFrame:
    """``(folder, Id, embedding)`` of subject and body of every mail."""
    text = compose_text(F.col("ExtractedSubject"), F.col("ExtractedBodyText"))
    return embed(corpus.select("folder", "Id", text.alias("text")), "text", encoder, batch_size, dim)
