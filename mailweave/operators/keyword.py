"""BM25 scoring and keyword search over the index tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweave.functions.text import tokens
from mailweave.operators.joins import ROW_BYTES, attach, broadcast_limit, measured_bytes
from mailweave.operators.mailbox import FOLDERS
from mailweave.operators.query_parse import by_name_word
from mailweave.operators.ranking import by_score, first_n
from mailweave.session import stored
from mailweave.sources.postings import FIELDS, Index, exact_values

# BM25 parameters and boosts.
K1 = 1.2
B = 0.75
SENDER_BOOST = 2.0
DATE_BOOST = 1.5
MATCH_FIELDS = ("subject", "body")
LITERAL_TERMS = 100  # words whose postings are asked for by name


def query_terms(queries: DataFrame, fields: tuple[str, ...], text_col: str = "query") -> DataFrame:
    """``(qid, field, term, weight)``; a repeated word counts as often as it occurs."""
    words = queries.select("qid", F.explode(tokens(F.col(text_col))).alias("term"))
    counted = words.groupBy("qid", "term").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    field = F.explode(F.array(*[F.lit(f) for f in fields])).alias("field")
    return counted.select("qid", field, "term", "weight")


def contributions(
    index: Index, terms: DataFrame, k1: float = K1, b: float = B, allowed: DataFrame | None = None
) -> DataFrame:
    """Posting rows that match ``terms(qid, field, term, weight)`` with their share ``part``.

    The terms are weighted by the dictionary first, where each becomes at most one row per
    folder. The postings are then read once and, where few of the terms are in the dictionary, not
    shuffled, however many are asked for. With
    ``allowed(folder, qid, Id)``, each row once, only these mails of a query are matched: they are
    joined to the postings before any word is, and the statistics stay those of all mails.
    """
    wanted = stored(terms, "terms")
    size = measured_bytes(wanted)
    folders = len(FOLDERS)
    matched = attach(index.terms, wanted, ["field", "term"], ["folder"], "inner", size)
    known = attach(
        matched,
        index.fields,
        ["folder", "field"],
        ["qid", "term"],
        "inner",
        len(FIELDS) * folders * ROW_BYTES,
    )
    idf = F.log1p((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = F.col("weight") * idf * (k1 + 1)
    weights = stored(known.select("folder", "field", "term", "qid", gain.alias("gain"), "avg_len"), "weights")
    postings = _of_terms(index.postings, wanted, size)
    keys = ["folder", "field", "term"]
    few = None if allowed is None else measured_bytes(allowed.select("folder", "qid", "Id"))
    if few is not None and few > broadcast_limit(allowed):
        postings, keys, allowed = _of_mails(postings, allowed.select("folder", "qid", "Id"), few), [*keys, "qid"], None
    if allowed is not None:
        postings = attach(postings, allowed.select("folder", "Id").distinct(), ["folder", "Id"], ["term"], "left_semi", few)
    hits = attach(postings, weights, keys, ["Id"], "inner")
    if allowed is not None:
        hits = attach(hits, allowed.select("folder", "qid", "Id"), ["folder", "qid", "Id"], ["term"], "left_semi", few)
    saturation = F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len"))
    return hits.withColumn("part", F.col("gain") * F.col("tf") / saturation)


def _of_mails(postings: DataFrame, allowed: DataFrame, size: int) -> DataFrame:
    """Postings of the mails ``allowed(folder, qid, Id)``, many of them, once for each of their queries.

    They are joined by the id alone, by which the stored postings are bucketed: these stay where
    they are. The folder is compared by order, as an equal key would make Spark shuffle them by both.
    """
    pairs = allowed.withColumnsRenamed({"folder": "_folder", "Id": "_id"})
    if size / int(allowed.sparkSession.conf.get("spark.sql.shuffle.partitions")) <= broadcast_limit(allowed):
        pairs = pairs.hint("shuffle_hash")
    same = (F.col("folder") <= F.col("_folder")) & (F.col("folder") >= F.col("_folder"))
    return postings.join(pairs, (F.col("Id") == F.col("_id")) & same).drop("_folder", "_id")


def _of_terms(postings: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Postings of few words are read through literal filters, which skip the pages of other words:
    within a file, postings are sorted by field and term."""
    if size > LITERAL_TERMS * 4 * ROW_BYTES:
        return postings
    found = wanted.select("field", "term").distinct().limit(LITERAL_TERMS + 1).collect()
    if len(found) > LITERAL_TERMS:
        return postings
    fields, words = ({r[c] for r in found} for c in ("field", "term"))
    return postings.filter(F.col("field").isin(*sorted(fields)) & F.col("term").isin(*sorted(words)))


def bm25(
    queries: DataFrame,
    index: Index,
    fields: tuple[str, ...] = MATCH_FIELDS,
    k1: float = K1,
    b: float = B,
    text_col: str = "query",
) -> DataFrame:
    """``(folder, qid, field, Id, score)`` for every mail that shares a word with the query."""
    return (
        contributions(index, query_terms(queries, fields, text_col), k1, b)
        .groupBy("folder", "qid", "field", "Id")
        .agg(F.sum("part").alias("score"))
    )


def match_best_field(
    queries: DataFrame,
    index: Index,
    fields: tuple[str, ...] = MATCH_FIELDS,
    sender_terms: DataFrame | None = None,
    k1: float = K1,
    b: float = B,
    text_col: str = "query",
    allowed: DataFrame | None = None,
) -> DataFrame:
    """``(folder, qid, Id, date_sent, best, sender)``: best matching field per mail.

    ``sender_terms(qid, field, term, weight)`` adds a boosted sender score, which never
    makes a hit by itself. Both come from one join and one aggregation of the postings.
    ``allowed(folder, qid, Id)`` names the only mails that may be hits, each once.
    """
    terms = query_terms(queries, fields, text_col)
    if sender_terms is not None:
        terms = terms.unionByName(sender_terms)
    sums = [F.sum(F.when(F.col("field") == f, F.col("part"))).alias(f"_{f}") for f in fields]
    sender = F.coalesce(F.sum(F.when(F.col("field") == "sender", F.col("part"))), F.lit(0.0))
    scored = contributions(index, terms, k1, b, allowed).groupBy("folder", "qid", "Id").agg(
        *sums, sender.alias("sender"), F.max("date_sent").alias("date_sent")
    )
    best = F.greatest(*[F.coalesce(F.col(f"_{f}"), F.lit(0.0)) for f in fields])
    return (
        scored.filter(F.coalesce(*[F.col(f"_{f}") for f in fields]).isNotNull())
        .select("folder", "qid", "Id", "date_sent", best.alias("best"), "sender")
    )


def sender_terms(parsed: DataFrame, aliases: DataFrame, boost: float = SENDER_BOOST) -> DataFrame:
    """``(qid, field, term, weight)`` of all aliases of the sender a query names.

    ``aliases(Name, Alias)`` is tokenised and counted per name before the join, so a
    name with many aliases stays one row per distinct word.
    """
    words = (
        aliases.select("Name", F.explode(tokens(F.col("Alias"))).alias("term"))
        .groupBy("Name", "term")
        .agg((F.count(F.lit(1)) * boost).cast("double").alias("weight"))
    )
    named = parsed.filter(F.col("sender").isNotNull()).select("qid", F.col("sender").alias("Name"))
    return attach(words, named, ["Name"], ["term"], "inner").select(
        "qid", F.lit("sender").alias("field"), "term", "weight"
    )


def keyword_search(
    parsed: DataFrame,
    index: Index,
    aliases: DataFrame | None = None,
    boosts: bool = True,
    mode: str = "boost",
    corpus: DataFrame | None = None,
    max_hits: int | None = None,
    match: str = "exact",
) -> DataFrame:
    """``(folder, qid, Id, score)`` of parsed queries.

    A mail is a hit when its subject or body shares a word with ``relevant_text``. In
    mode ``boost`` sender and date only raise scores (``boosts=False`` leaves them out);
    in mode ``filter`` they restrict the hits instead, by the exact values of the index, or
    of ``corpus`` where the index has none. A sender matches a full name exactly, or with ``match="word"`` any word of it, case-blind.
    """
    if mode not in ("boost", "filter"):
        raise ValueError(f"unknown keyword mode: {mode}")
    if match not in ("exact", "word"):
        raise ValueError(f"unknown sender match: {match}")
    if match == "word" and aliases is not None:
        aliases = by_name_word(aliases)
        parsed = parsed.withColumn("sender", F.lower("sender"))
    if mode == "filter":
        scored = _filtered(parsed, index, aliases, corpus)
    else:
        senders = sender_terms(parsed, aliases) if boosts and aliases is not None else None
        hits = match_best_field(parsed, index, sender_terms=senders, text_col="relevant_text")
        score = F.col("best")
        if boosts:
            hits = attach(hits, parsed.select("qid", "start_date", "end_date"), ["qid"], ["Id"], "left")
            score = F.col("best") + F.col("sender") + F.when(_inside(), DATE_BOOST).otherwise(0.0)
        scored = hits.select("folder", "qid", "Id", score.alias("score"))
    if max_hits is not None:
        scored = first_n(scored, ["folder", "qid"], max_hits, by_score())
    return scored


def _inside() -> Column:
    return (F.col("date_sent") >= F.col("start_date")) & (F.col("date_sent") < F.col("end_date"))


def _filtered(parsed: DataFrame, index: Index, aliases: DataFrame | None, corpus: DataFrame | None) -> DataFrame:
    """Hits whose sender is an alias of the person named and whose date is in the range asked for;
    a query that names nobody known, or no date, is not restricted by it.

    The mails that a query may find come from the exact values of the index, by alias or else by
    date, before anything is scored. Queries without any condition are scored as usual.
    """
    exact = index.exact
    if exact is None and corpus is not None:
        exact = exact_values(corpus)
    if exact is None or aliases is None:
        raise ValueError("mode 'filter' needs aliases, and exact values in the index or a corpus")
    pairs = aliases.select("Name", "Alias").distinct()
    asked = parsed.select("qid", F.col("sender").alias("Name"), "start_date", "end_date")
    known = pairs.select("Name").distinct().withColumn("known", F.lit(True))
    asked = stored(attach(asked, known, ["Name"], ["qid"], "left"), "conditions")
    by_name = attach(asked.filter("known"), pairs, ["Name"], ["qid"], "inner").withColumnRenamed("Alias", "value")
    senders = exact.filter(F.col("field") == "sender").select("folder", "value", "Id", "date_sent")
    named = attach(senders, by_name, ["value"], ["Id"], "inner")
    allowed = named.filter(F.col("start_date").isNull() | _inside()).select("folder", "qid", "Id")
    # Days are few: a range becomes the days in it, and these the mails.
    dated = asked.filter("known IS NULL AND start_date IS NOT NULL AND end_date > start_date")
    days = F.sequence(F.col("start_date").cast("date"), F.date_sub(F.col("end_date").cast("date"), 1))
    dates = exact.filter(F.col("field") == "date_sent").select("folder", "Id", "date_sent", F.col("date_sent").cast("date").alias("day"))
    in_range = attach(dates, dated.select("qid", "start_date", "end_date", F.explode(days).alias("day")), ["day"], ["Id"], "inner")
    allowed = allowed.unionByName(in_range.filter(_inside()).select("folder", "qid", "Id"))
    allowed = stored(allowed.distinct(), "allowed")
    condition = F.col("known").isNotNull() | F.col("start_date").isNotNull()
    tied = attach(parsed, asked.filter(condition).select("qid").distinct(), ["qid"], ["query"], "left_semi")
    free = attach(parsed, asked.filter(~condition).select("qid").distinct(), ["qid"], ["query"], "left_semi")
    found = match_best_field(tied, index, text_col="relevant_text", allowed=allowed)
    found = found.unionByName(match_best_field(free, index, text_col="relevant_text"))
    return found.select("folder", "qid", "Id", F.col("best").alias("score"))
