"""Query understanding: sender, date range, relevant words, variants."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweave.functions.dates import date_mention, mention_start
from mailweave.functions.stopwords import ENGLISH_STOP_WORDS
from mailweave.functions.text import TOKEN, WHITESPACE, WORD, let, strip
from mailweave.operators.joins import attach
from mailweave.operators.ranking import rank_within

# Fixed value: the pattern of a sender mention.
SENDER_MENTION = rf"(?i)(?<![{WORD}])from(?=[{WHITESPACE}]+([{WORD}]+))"


def _not_stop(word: Column, stopwords: list[str]) -> Column:
    return ~F.lower(word).isin(*stopwords) if stopwords else F.lit(True)


def extract_sender(col: Column, stopwords: list[str]) -> Column:
    """First word after a ``from`` that can be a name: has a letter, is no stop word."""
    after = F.regexp_extract_all(col, F.lit(SENDER_MENTION), F.lit(1))
    return F.get(
        F.filter(after, lambda w: w.rlike(r"\p{L}") & _not_stop(w, stopwords)), F.lit(0)
    )


def extract_date_range(col: Column, as_of: str | Column | None = None) -> Column:
    """``struct<start_date, end_date>`` of the first date mention (see ``functions.dates``): one
    month from its start. ``as_of`` is the current date by default."""
    today = F.current_date() if as_of is None else as_of
    today = F.lit(today).cast("date") if isinstance(today, str) else today
    start = let(date_mention(col), lambda m: mention_start(m, today))
    return let(
        start,
        lambda s: F.struct(
            s.cast("timestamp_ntz").alias("start_date"),
            F.add_months(s, 1).cast("timestamp_ntz").alias("end_date"),
        ),
    )


def relevant_text(col: Column, stopwords: list[str]) -> Column:
    """Alphabetic words that are no stop words; the lower-case query if none is left."""
    words = F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(TOKEN), F.lit(0))
    kept = F.array_join(
        F.filter(words, lambda w: w.rlike(r"^\p{L}+$") & _not_stop(w, stopwords)), " "
    )
    return let(kept, lambda t: F.when(t == "", F.lower(strip(col))).otherwise(t))


def parse_queries(
    queries: DataFrame,
    as_of: str | Column | None = None,
    stopwords: list[str] | None = None,
) -> DataFrame:
    """``(qid, query, sender, start_date, end_date, relevant_text)``: projections only."""
    words = ENGLISH_STOP_WORDS if stopwords is None else stopwords
    query = F.col("query")
    return queries.withColumn("_range", extract_date_range(query, as_of)).select(
        *queries.columns,
        extract_sender(query, words).alias("sender"),
        F.col("_range.start_date").alias("start_date"),
        F.col("_range.end_date").alias("end_date"),
        relevant_text(query, words).alias("relevant_text"),
    )


def by_name_word(rows: DataFrame) -> DataFrame:
    """Alias rows keyed by each lower-case word of the name instead of the full name."""
    word = F.explode(F.array_distinct(F.split(F.lower(strip(F.col("Name"))), rf"[{WHITESPACE}]+")))
    return rows.select(word.alias("Name"), "Alias").distinct()


def resolve_sender(parsed: DataFrame, aliases: DataFrame) -> DataFrame:
    """Add ``possible_senders``: aliases of the person named, null when unknown.

    ``aliases(Name, aliases)`` holds one row per name; names match exactly. Its other columns, facts
    of a list such as its length, come along: they are taken once per name, and a list that is not
    asked for afterwards is copied to no query.
    """
    lookup = aliases.withColumnsRenamed({"Name": "sender", "aliases": "possible_senders"})
    return attach(parsed, lookup, ["sender"], ["qid"])


def expand_queries(
    queries: DataFrame,
    variants: DataFrame | None = None,
    generator: Callable[[str], list[str]] | None = None,
) -> DataFrame:
    """``(qid, variant_no, variant)``: distinct lower-case paraphrases and the query itself.

    Paraphrases come as a table ``(qid, [variant_no,] variant)`` or from ``generator``,
    which is called in the tasks. The query is variant 0; of equal texts the lowest
    number stays.
    """
    original = queries.select("qid", F.lit(0).alias("variant_no"), F.col("query").alias("variant"))
    if generator is not None:
        variants = _generated(queries, generator)
    if variants is not None:
        if "variant_no" not in variants.columns:
            variants = rank_within(
                variants.select("qid", "variant").distinct(), ["qid"], [F.col("variant")], "variant_no"
            ).withColumn("variant_no", F.col("variant_no") + 1)
        numbered = variants.select("qid", F.col("variant_no").cast("int").alias("variant_no"), "variant")
        original = original.unionByName(numbered)
    return (
        original.filter(F.col("variant").isNotNull())
        .groupBy("qid", F.lower("variant").alias("variant"))
        .agg(F.min("variant_no").alias("variant_no"))
        .select("qid", "variant_no", "variant")
    )


def _generated(queries: DataFrame, generator: Callable[[str], list[str]]) -> DataFrame:
    def paraphrase(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (qid, i + 1, text)
                for qid, query in zip(batch["qid"], batch["query"])
                for i, text in enumerate(generator(query))
            ]
            yield pd.DataFrame(rows, columns=["qid", "variant_no", "variant"])

    return queries.select("qid", "query").mapInPandas(
        paraphrase, "qid bigint, variant_no int, variant string"
    )
