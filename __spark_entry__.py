"""Registered queries over the given tables, each with the same question in SQL.

Input shapes (mails, people, queries, vectors) are projections of the whole tables; no
query takes a subset of its input. Scores are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import wraps

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.functions import text as tx
from mailweave.functions.stopwords import ENGLISH_STOP_WORDS
from mailweave.functions.vectors import hash_encode, l2_normalize, rank_decay, semantic_weight
from mailweave.operators import mailbox as mb
from mailweave.operators import metrics as mt
from mailweave.operators.dense import dense_rank_all, dense_scores
from mailweave.operators.encode import embed, embed_queries
from mailweave.operators.examples import letter_encoder, same_and_doubled
from mailweave.operators.fusion import combine, min_max, rrf
from mailweave.operators.keyword import bm25, keyword_search, match_best_field, sender_terms
from mailweave.operators.query_parse import (
    by_name_word,
    expand_queries,
    parse_queries,
    resolve_sender,
)
from mailweave.operators.ranking import by_score, hit_cap, number_docs, rank_all, top_n
from mailweave.plans.evaluation import evaluate
from mailweave.plans.mailboxes import build_mailboxes, build_vectors
from mailweave.plans.search import Store, fetch, load_store, open_store, save_store, search, search_scores
from mailweave.session import scratch_path, ship, stored
from mailweave.sources import raw as rw
from mailweave.sources import reports as rp
from mailweave.sources import store as st
from mailweave.sources.postings import build_postings, load_index, write_index

# The operators of the llm folder may be taken out of a checkout.
try:
    from mailweave.llm import registry as llm
except ImportError as missing:
    if not (missing.name or "").startswith("mailweave.llm"):
        raise
    llm = None

OWNER = "nation_7$"
Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------- inputs


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def mails(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as mails of two folders."""
    sent_at = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(doc_id % 30 as int))")
    return table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 4 == 0, "sent").otherwise("inbox").alias("folder"),
        F.col("doc_id").alias("Id"),
        F.get(F.split("text", "\n"), F.lit(0)).alias("ExtractedSubject"),
        F.col("text").alias("ExtractedBodyText"),
        F.concat(F.lit("Customer#"), F.lpad((F.col("doc_id") % 150).cast("string"), 9, "0")).alias(
            "ExtractedFrom"
        ),
        F.col("source").alias("ExtractedCc"),
        F.date_format(sent_at, "EEEE, MMMM d, yyyy hh:mm a").alias("ExtractedDateSent"),
    )


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return st.with_dates(mails(spark, sf)).withColumn("ExtractedTo", F.col("ExtractedFrom"))


def people(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Raw tables of the mailbox build."""
    return {
        "Emails": mails(spark, sf).drop("folder").withColumn("ExtractedTo", F.lit(None).cast("string")),
        "EmailReceivers": table(spark, sf, "orders").select(
            F.expr("o_orderkey div 3").alias("EmailId"),
            (F.col("o_custkey") % 25).alias("PersonId"),
            F.col("o_orderkey").alias("ord"),
        ),
        "Aliases": table(spark, sf, "customer").select(
            F.col("c_name").alias("Alias"),
            F.col("c_nationkey").cast("bigint").alias("PersonId"),
            F.col("c_custkey").alias("ord"),
        ),
        "Persons": table(spark, sf, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("Id"), F.col("n_name").alias("Name")
        ),
    }


def benchmark(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark passages as queries in sets of four."""
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("qid"),
        F.col("text").alias("query"),
        F.expr("item_id div 4").alias("set_id"),
        F.when(F.expr("item_id div 4") % 2 == 0, "even").otherwise("odd").alias("group"),
    )


def paraphrases(spark: SparkSession, sf: str) -> DataFrame:
    """The passage in upper case, and the passage followed by the next one."""
    items = table(spark, sf, "benchmark")
    after = items.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("after"))
    longer = items.join(after, "item_id").select(
        F.col("item_id").alias("qid"),
        F.lit(2).alias("variant_no"),
        F.concat_ws(" ", "text", "after").alias("variant"),
    )
    same = items.select(
        F.col("item_id").alias("qid"), F.lit(1).alias("variant_no"), F.upper("text").alias("variant")
    )
    return same.unionByName(longer)


def named_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Passages that also name a sender and a day."""
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    items = table(spark, sf, "benchmark").withColumn("k", (F.col("item_id") % 25).cast("int"))
    return items.join(names, "k").select(
        F.col("item_id").alias("qid"),
        F.concat(
            F.col("text"),
            F.lit(" from "),
            F.col("n_name"),
            F.lit(" on January "),
            (F.col("item_id") % 28 + 1).cast("string"),
            F.lit(", 2024"),
        ).alias("query"),
    )


def dated_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as short queries with a sender and a date in one of five forms."""
    orders = table(spark, sf, "orders")
    day = F.col("o_orderdate")
    form = (
        F.when(F.col("o_orderkey") % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 5 == 1, F.date_format(day, "MMMM d, yyyy"))
        .when(F.col("o_orderkey") % 5 == 2, F.date_format(day, "MMMM yyyy"))
        .when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit("last "), F.date_format(day, "MMMM")))
        .otherwise(F.date_format(day, "yyyy"))
    )
    return orders.select(
        F.col("o_orderkey").alias("qid"),
        F.concat(
            F.lit("Mail from NATION_"),
            (F.col("o_custkey") % 30).cast("string"),
            F.lit(" about the priority "),
            F.col("o_orderpriority"),
            F.lit(" of "),
            form,
        ).alias("query"),
    )


def alias_rows(spark: SparkSession, sf: str) -> DataFrame:
    raw = people(spark, sf)
    return mb.name_alias_rows(raw["Aliases"], raw["Persons"]).drop("ord")


def given_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.when(F.col("vec_id") % 4 == 0, "sent").otherwise("inbox").alias("folder"),
        F.col("vec_id").alias("Id"),
        "embedding",
    )


def vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Every given vector as one of four variants of a query."""
    return table(spark, sf, "embeddings").select(
        F.expr("vec_id div 4").alias("qid"),
        (F.col("vec_id") % 4).cast("int").alias("variant_no"),
        "embedding",
    )


_stores: dict[tuple[str, str], Store] = {}


def store(spark: SparkSession, sf: str) -> Store:
    """Mails, their hashed vectors and their keyword index, all written; built once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stores:
        path = scratch_path(spark, "mailbox")
        st.write_mailbox(corpus(spark, sf), path)
        _stores[key] = open_store(st.load_corpus(spark, path), alias_rows(spark, sf))
    return _stores[key]


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --------------------------------------------------------------------------- text


def q_tokens(spark, sf):
    words = tx.tokens(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id",
        F.size(words).cast("bigint").alias("n_tokens"),
        F.md5(F.array_join(words, " ")).alias("words_md5"),
    )


def q_clean_body(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text"
    )
    pages = table(spark, sf, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    return docs.unionByName(pages).select("kind", "id", tx.clean_body(F.col("text")).alias("body"))


def q_clean_subject(spark, sf):
    return mails(spark, sf).select(
        "Id",
        tx.clean_subject(F.col("ExtractedSubject")).alias("subject"),
        tx.clean_subject(F.concat(F.lit("RE:  "), "ExtractedSubject")).alias("reply"),
        tx.clean_subject(F.concat(F.lit("Fwd: "), "ExtractedSubject"), strip_reply=True).alias("stripped"),
    )


def q_extract_alias(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        tx.extract_alias(F.col("text")).alias("alias"),
        tx.extract_alias(F.concat("source", F.lit(" < "), "text", F.lit("> x"))).alias("angled"),
    )


def _event_dates(spark, sf):
    ts = F.col("ts").cast("timestamp_ntz")
    k = F.col("event_id") % 5
    text = (
        F.when(k == 0, F.date_format(ts, "EEEE, MMMM d, yyyy hh:mm a"))
        .when(k == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(k == 2, F.date_format(ts, "M/d/yyyy"))
        .when(k == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.concat(F.col("event_type"), F.lit(" OM")))
    )
    return table(spark, sf, "events").select("event_id", "event_type", text.alias("sent"))


def q_iso_date(spark, sf):
    return _event_dates(spark, sf).select("event_id", tx.iso_date(F.col("sent")).alias("iso"))


def q_date_repair(spark, sf):
    fixed = tx.repair_date_text(F.col("sent"))
    return _event_dates(spark, sf).select(
        "event_id", fixed.alias("repaired"), tx.iso_date(fixed).alias("iso")
    )


def q_compose_text(spark, sf):
    blank = F.when(F.col("Id") % 3 == 0, None).otherwise(F.col("ExtractedSubject"))
    return mails(spark, sf).select(
        "Id", tx.compose_text(blank, F.col("ExtractedBodyText")).alias("text")
    )


def _lengths(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text"
    )
    words = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_custkey").alias("id"),
        F.expr("repeat(c_mktsegment || '  ', cast(c_custkey % 12 as int))").alias("text"),
    )
    return docs.unionByName(words)


def q_query_len_weight(spark, sf):
    length = tx.query_len(F.col("text"))
    return _lengths(spark, sf).select(
        "kind",
        "id",
        length.cast("bigint").alias("n_words"),
        F.round(semantic_weight(length), 6).alias("weight"),
    )


def q_query_prompt(spark, sf):
    return benchmark(spark, sf).select("qid", tx.query_prompt(F.col("query")).alias("prompt"))


def q_hash_encode(spark, sf):
    # The small files hold one row group each; hashing is heavy per text, so spread it.
    docs = table(spark, sf, "documents").repartition("doc_id")
    docs = docs.select("doc_id", hash_encode(F.col("text")).alias("v"))
    return docs.select("doc_id", F.posexplode("v").alias("pos", "value")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("value").cast("double"), 6).alias("value")
    )


def q_owner_flag(spark, sf):
    return people(spark, sf)["Persons"].select("Id", tx.is_owner(F.col("Name"), OWNER).alias("owner"))


# --------------------------------------------------------------------------- mailbox


def q_alias_names(spark, sf):
    raw = people(spark, sf)
    doubled = raw["Aliases"].unionByName(
        raw["Aliases"].withColumn("PersonId", (F.col("PersonId") + 1) % 25).withColumn(
            "ord", F.col("ord") + F.when(F.col("ord") % 2 == 0, 1_000_000_000).otherwise(-1_000_000_000)
        )
    )
    return mb.alias_names(doubled, raw["Persons"])


def q_name_aliases(spark, sf):
    raw = people(spark, sf)
    return rw.load_name_aliases(raw).select(
        "Name", F.size("aliases").cast("bigint").alias("n"), F.array_join("aliases", "|").alias("aliases")
    )


def q_recipients(spark, sf):
    raw = people(spark, sf)
    return mb.recipients(raw["EmailReceivers"], raw["Persons"]).select(
        "EmailId", F.array_join("ExtractedTo", "|").alias("names")
    )


def q_sender_names(spark, sf):
    raw = people(spark, sf)
    emails = raw["Emails"].withColumn(
        "ExtractedFrom", F.when(F.col("Id") % 7 == 0, None).otherwise(F.col("ExtractedFrom"))
    )
    named = mb.with_senders(emails, mb.alias_names(raw["Aliases"], raw["Persons"]))
    return mb.fill_sender(named).select("Id", "ExtractedFrom", "CleanedAlias", "SenderName")


def q_inbox_mails(spark, sf):
    raw = people(spark, sf)
    return mb.inbox_mails(raw["Emails"], raw["EmailReceivers"], raw["Persons"], OWNER).select("Id")


def q_sent_mails(spark, sf):
    raw = people(spark, sf)
    return mb.sent_mails(raw["Emails"], raw["Aliases"], raw["Persons"], OWNER).select("Id", "CleanedAlias")


def _boxes(spark, sf):
    return build_mailboxes(people(spark, sf), OWNER)


def q_mailboxes(spark, sf):
    return _boxes(spark, sf).withColumn("ExtractedTo", F.array_join("ExtractedTo", "|"))


def q_mailboxes_clean(spark, sf):
    return build_mailboxes(people(spark, sf), OWNER, keep_clean=True).select(
        "folder",
        "Id",
        "subject",
        F.md5("body").alias("body_md5"),
        F.date_format("date", "yyyy-MM-dd HH:mm").alias("date"),
        "CleanedAlias",
        "SenderName",
    )


def q_mailbox_stats(spark, sf):
    return mb.mailbox_stats(_boxes(spark, sf))


def q_corpus(spark, sf):
    path = scratch_path(spark, "mailbox")
    st.write_mailbox(_boxes(spark, sf), path)
    loaded = st.with_dates(st.load_corpus(spark, path))
    return loaded.select("folder", "Id", F.md5("ExtractedBodyText").alias("body_md5"), "ExtractedDateSent")


def q_doc_numbers(spark, sf):
    return number_docs(mails(spark, sf).select("folder", "Id"))


def q_raw_csv(spark, sf):
    raw = people(spark, sf)
    path = scratch_path(spark, "raw")
    for name, df in raw.items():
        rows = df.drop("ord").write.option("header", True).option("escape", '"')
        rows.csv(f"{path}/{name}.csv")
    read = rw.read_raw(spark, path)
    emails = read["Emails"].select(
        F.lit("Emails").alias("source"),
        F.col("Id").alias("a"),
        F.md5(F.concat_ws("|", "ExtractedSubject", "ExtractedBodyText", "ExtractedDateSent")).alias("b"),
    )
    pair = lambda n, a, b: read[n].select(
        F.lit(n).alias("source"), F.col(a).cast("bigint").alias("a"), F.col(b).cast("string").alias("b")
    )
    return (
        emails.unionByName(pair("EmailReceivers", "EmailId", "PersonId"))
        .unionByName(pair("Aliases", "PersonId", "Alias"))
        .unionByName(pair("Persons", "Id", "Name"))
    )


# --------------------------------------------------------------------------- keyword


def q_postings(spark, sf):
    return build_postings(corpus(spark, sf)).postings.select(
        "folder", "field", "term", "Id", F.col("tf").cast("bigint").alias("tf"), F.col("len").cast("bigint").alias("len")
    )


def q_postings_exact(spark, sf):
    """Whole values of the stored index; recipients as an array with a repeated value."""
    mails_ = corpus(spark, sf).withColumn("ExtractedTo", F.array("ExtractedTo", "ExtractedCc", "ExtractedTo"))
    path = scratch_path(spark, "index")
    write_index(mails_, path)
    return load_index(spark, path).exact.select("folder", "field", "value", "Id")


def q_term_stats(spark, sf):
    return build_postings(corpus(spark, sf)).terms


def q_field_stats(spark, sf):
    return rounded(build_postings(corpus(spark, sf)).fields, "avg_len")


def q_bm25_scores(spark, sf):
    return rounded(bm25(benchmark(spark, sf), store(spark, sf).index), "score")


def q_bm25_best_field_top10(spark, sf):
    s = store(spark, sf)
    hits = match_best_field(benchmark(spark, sf), s.index).withColumnRenamed("best", "score")
    top = top_n(hits.select("folder", "qid", "Id", "score"), ["folder", "qid"], 10, by_score())
    rows = fetch(top, s.corpus, 20 * benchmark(spark, sf).count())
    return rounded(rows.select("folder", "qid", "rank", "Id", "score", "ExtractedSubject"), "score")


def _keyword(spark, sf, **options):
    s = store(spark, sf)
    parsed = parse_queries(named_queries(spark, sf))
    return rounded(keyword_search(parsed, s.index, s.aliases, corpus=s.corpus, **options), "score")


def q_sender_boost(spark, sf):
    s = store(spark, sf)
    parsed = parse_queries(named_queries(spark, sf))
    hits = match_best_field(
        parsed, s.index, sender_terms=sender_terms(parsed, s.aliases), text_col="relevant_text"
    )
    return rounded(hits.select("folder", "qid", "Id", "best", "sender"), "best", "sender")


def q_keyword_boosted(spark, sf):
    return _keyword(spark, sf)


def q_keyword_as_run(spark, sf):
    return _keyword(spark, sf, boosts=False)


def q_keyword_filtered(spark, sf):
    return _keyword(spark, sf, mode="filter")


def q_hit_cap(spark, sf):
    return _keyword(spark, sf, max_hits=hit_cap(store(spark, sf).corpus))


def q_metrics_with_empty_list(spark, sf):
    """Agreement of sets to which a first query without any hit was added."""
    queries = benchmark(spark, sf)
    empty = queries.select("set_id", (-1 - F.col("set_id")).alias("qid")).filter("set_id % 2 = 0").distinct()
    sets = queries.select("set_id", "qid").unionByName(empty)
    ranked = _stored_rankings(spark, sf)
    agreement = mt.weighted_kendalls_w(ranked, KEYS, sets=sets)
    return rounded(agreement.join(mt.check_same_ids(ranked, KEYS, sets), KEYS), "kendalls_w")


# --------------------------------------------------------------------------- dense


def q_l2_normalize(spark, sf):
    scaled = F.transform("embedding", lambda x: x.cast("double") * 3)
    rows = table(spark, sf, "embeddings").select("vec_id", F.posexplode(l2_normalize(scaled)).alias("pos", "value"))
    return rows.select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("value").cast("double"), 5).alias("value")
    )


def q_dense_top10(spark, sf):
    ranked = dense_rank_all(vector_queries(spark, sf), given_vectors(spark, sf), depth=10)
    return rounded(ranked.withColumn("variant_no", F.col("variant_no").cast("bigint")), "score")


def q_rrf_fused(spark, sf):
    return rounded(rrf(dense_rank_all(vector_queries(spark, sf), given_vectors(spark, sf), per_query=True)), "score")


def q_vector_table(spark, sf):
    path = scratch_path(spark, "vectors")
    st.write_vectors(build_vectors(corpus(spark, sf)), path)
    both = st.load_vectors(spark, path, "inbox").unionByName(st.load_vectors(spark, path, "sent"))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return both.select(
        "folder", "Id", F.size("embedding").cast("bigint").alias("dim"), F.round(total, 5).alias("total")
    )


def q_embed_model(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = embed(docs, "text", letter_encoder).select("doc_id", F.posexplode("embedding").alias("pos", "value"))
    return rows.select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("value").cast("double"), 5).alias("value")
    )


def q_embed_queries_model(spark, sf):
    rows = embed_queries(
        expand_queries(benchmark(spark, sf), paraphrases(spark, sf)), letter_encoder
    ).select("qid", "variant_no", F.posexplode("embedding").alias("pos", "value"))
    return rows.select(
        "qid",
        F.col("variant_no").cast("bigint").alias("variant_no"),
        F.col("pos").cast("bigint").alias("pos"),
        F.round(F.col("value").cast("double"), 5).alias("value"),
    )


# --------------------------------------------------------------------------- hybrid


def q_min_max(spark, sf):
    hits = match_best_field(benchmark(spark, sf), store(spark, sf).index)
    scores = hits.select(F.concat_ws("-", "folder", "qid").alias("key"), "Id", F.col("best").alias("score"))
    return min_max(scores, "key").select("key", "Id", F.round("norm", 6).alias("norm"))


def q_combined_top10(spark, sf):
    """Given vectors, which only some mails have, with keyword scores."""
    s = store(spark, sf)
    queries = benchmark(spark, sf)
    known = given_vectors(spark, sf).join(s.corpus.select("folder", "Id"), ["folder", "Id"], "left_semi")
    # Products of vectors are signed, so mails without one rank in the middle.
    # Every vector is a variant of some query.
    variant = (F.col("vec_id") % queries.count()).alias("qid")
    wanted = table(spark, sf, "embeddings").select(variant, F.col("vec_id").alias("variant_no"), "embedding")
    sem = dense_scores(wanted, known, per_query=True).groupBy("folder", "qid", "Id").agg(F.max("score").alias("score"))
    kw = match_best_field(queries, s.index).select("folder", "qid", "Id", F.col("best").alias("score"))
    return rounded(combine(sem, kw, queries, s.corpus, n=10), "score")


def q_full_ranking(spark, sf):
    hits = match_best_field(benchmark(spark, sf), store(spark, sf).index)
    scores = hits.select("folder", "qid", "Id", F.col("best").alias("score"))
    return rounded(rank_all(scores, ["folder", "qid"]), "score")


def _search(spark, sf, mode, n=10):
    found = search_scores(
        benchmark(spark, sf), store(spark, sf), mode=mode, n=n, variants=paraphrases(spark, sf)
    )
    return rounded(found, "score")


def q_search_semantic(spark, sf):
    return _search(spark, sf, "semantic")


def q_search_keyword(spark, sf):
    return _search(spark, sf, "keyword")


def q_search_hybrid(spark, sf):
    return _search(spark, sf, "hybrid")


def q_search_hybrid_full(spark, sf):
    return _search(spark, sf, "hybrid", n=None)


# --------------------------------------------------------------------------- queries


def _alias_lists(raw):
    """Aliases of a name with facts that are taken once per name, not per query."""
    return rw.load_name_aliases(raw).withColumns(
        {"n": F.size("aliases").cast("bigint"), "aliases_md5": F.md5(F.array_join("aliases", "|"))}
    )


def q_sender_alias(spark, sf):
    raw = people(spark, sf)
    parsed = parse_queries(dated_queries(spark, sf))
    resolved = resolve_sender(parsed, _alias_lists(raw))
    return resolved.select("qid", "sender", "n", "aliases_md5")


def q_sender_by_word(spark, sf):
    words = by_name_word(alias_rows(spark, sf))
    return words.groupBy("Name").agg(F.count(F.lit(1)).alias("n"))


def q_date_range(spark, sf):
    parsed = parse_queries(dated_queries(spark, sf), as_of="1998-12-15")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return parsed.select("qid", day("start_date").alias("start_date"), day("end_date").alias("end_date"))


def q_date_forms(spark, sf):
    """Orders as sentences with a date in one of fourteen forms, some without any."""
    day, form = F.col("o_orderdate"), F.col("o_orderkey") % 14
    written = lambda pattern: F.date_format(day, pattern)
    forms = [
        written("M/d/yyyy"), written("d MMMM yyyy"), F.concat(F.lit("the "), written("d"), F.lit("th of "), written("MMMM yyyy")),
        written("MMM. yyyy"), written("MMMM d"), written("d MMM"), F.lit("last week"), F.lit("Last  month"), F.lit("last year"),
        F.lit("yesterday"), F.lit("today"), F.concat(F.lit("last "), written("MMM")), F.concat(F.lit("in 7-UP or "), written("yyyy-MM-dd")),
        F.lit("2012/13 or a last may be"),
    ]
    text = F.lit(None).cast("string")
    for k, each in enumerate(forms):
        text = F.when(form == k, each).otherwise(text)
    asked = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("qid"), F.concat(F.lit("Mail 5 of the 1234 from Bob ("), text, F.lit("), please")).alias("query")
    )
    parsed = parse_queries(asked, as_of="1998-12-15")
    date = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return parsed.select("qid", date("start_date"), date("end_date"))


def q_relevant_text(spark, sf):
    return parse_queries(named_queries(spark, sf)).select("qid", "relevant_text")


def q_parsed_queries(spark, sf):
    raw = people(spark, sf)
    parsed = parse_queries(dated_queries(spark, sf), as_of="1998-12-15")
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return resolve_sender(parsed, _alias_lists(raw)).select(
        "qid",
        "relevant_text",
        day("start_date"),
        day("end_date"),
        F.col("n").alias("n_senders"),
    )


def q_keyword_by_word(spark, sf):
    return _keyword(spark, sf, match="word")


def q_variants(spark, sf):
    return expand_queries(benchmark(spark, sf), paraphrases(spark, sf)).select(
        "qid", F.col("variant_no").cast("bigint").alias("variant_no"), "variant"
    )


def q_variants_generated(spark, sf):
    return expand_queries(benchmark(spark, sf), generator=same_and_doubled).select(
        "qid", F.col("variant_no").cast("bigint").alias("variant_no"), "variant"
    )


# --------------------------------------------------------------------------- evaluation


def _keyword_rankings(spark, sf):
    queries = benchmark(spark, sf)
    ranked = search_scores(queries, store(spark, sf), mode="keyword", n=None)
    return ranked.join(queries.select("qid", "set_id", "group"), "qid")


def _stored_rankings(spark, sf):
    return stored(_keyword_rankings(spark, sf), "rankings")


KEYS = ["folder", "set_id"]


def q_best4_across(spark, sf):
    return rounded(mt.best_across(_stored_rankings(spark, sf), KEYS), "score")


def q_kendalls_w(spark, sf):
    return rounded(mt.weighted_kendalls_w(_stored_rankings(spark, sf), KEYS), "kendalls_w")


def q_pairwise_mse(spark, sf):
    return rounded(mt.weighted_pairwise_mse(_keyword_rankings(spark, sf), KEYS), "pairwise_mse")


def q_same_ids(spark, sf):
    hits = match_best_field(benchmark(spark, sf), store(spark, sf).index)
    ranked = stored(hits.join(benchmark(spark, sf).select("qid", "set_id"), "qid"), "rankings")
    return mt.check_same_ids(ranked, KEYS)


def q_rank_decay(spark, sf):
    ranked = _keyword_rankings(spark, sf)
    return ranked.select("folder", "qid", "Id", F.round(rank_decay(F.col("rank")), 6).alias("weight"))


def q_metric_summary(spark, sf):
    result = evaluate(benchmark(spark, sf), store(spark, sf), mode="keyword")
    names = [f"{m}_{s}" for m in ("kendalls_w", "pairwise_mse") for s in ("mean", "std")]
    return rounded(result.summary, *names)


def q_evaluate_hybrid(spark, sf):
    result = evaluate(
        benchmark(spark, sf), store(spark, sf), mode="hybrid", variants=paraphrases(spark, sf)
    )
    return rounded(result.metrics.select("folder", "set_id", "kendalls_w", "pairwise_mse"), "kendalls_w", "pairwise_mse")


# --------------------------------------------------------------------------- reports


def q_report(spark, sf):
    found = search(benchmark(spark, sf), store(spark, sf), mode="keyword", n=3)
    return rp.format_results(found, benchmark(spark, sf))


def q_set_report(spark, sf):
    result = evaluate(benchmark(spark, sf), store(spark, sf), mode="keyword")
    return rp.format_set_results(result.best, benchmark(spark, sf))


def q_report_file(spark, sf):
    """The lines of a report in order: an older one, replaced by a new session, and an append."""
    report = q_report(spark, sf)
    path = scratch_path(spark, "report")
    rp.write_report(report.filter("rank >= 0"), path, mode="append")
    rp.write_report(report, path, mode="overwrite")
    rp.write_report(report.filter("rank < 0"), path, mode="append")
    return rp.read_report(spark, path)


def q_search_numbered(spark, sf):
    """Keyword results with their position in the folder, from a store that was saved and opened again."""
    s, path = store(spark, sf), scratch_path(spark, "store")
    save_store(s.corpus, path, s.aliases)
    opened = load_store(s.corpus, path)
    found = search(benchmark(spark, sf), opened, n=5, mode="keyword", numbered=True)
    return found.select("folder", "qid", "rank", "Id", "doc_no")


def _shipped(query: Query) -> Query:
    """The query, run after the package was sent to the Python workers."""

    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return query(spark, sf)

    return run


def queries() -> dict[str, Query]:
    """One entry per registered query."""
    found = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    return {name: _shipped(fn) for name, fn in found.items()} | (llm.queries() if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    """Keyword search of every benchmark passage over the smallest tables."""
    return q_bm25_best_field_top10(spark, "/root/testdata/sf0.001")


# --------------------------------------------------------------------------- SQL

TIE = "(score * 131073.0::DOUBLE) - (score * 131073.0::DOUBLE - score)"
PAT = tx.TOKEN.replace("'", "''")
WS = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
NOT_WORD = rf"[^\p{{L}}\p{{N}}_{WS}]"


def _stopwords() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def _words_only(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({x}), '{NOT_WORD}', ' ', 'g'), '[{WS}]+', ' ', 'g'))"


def _clean_body(x: str) -> str:
    return _words_only(
        rf"regexp_replace(regexp_replace({x}, '^.*?From', ''), 'UNCLASSIFIED.*?STATE.*\n', '', 'g')"
    )


def _alias(x: str) -> str:
    t = _strip(f"lower(coalesce({x}, ''))")
    address = r"[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+"
    return (
        rf"CASE WHEN regexp_matches({t}, '<.*?>') THEN {_strip(f'regexp_extract({t}, ' + chr(39) + '<(.*?)>' + chr(39) + ', 1)')} "
        rf"WHEN regexp_matches({t}, '{address}') THEN regexp_extract({t}, '{address}') ELSE {t} END"
    )


def _tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '{PAT}')"


def _length(x: str) -> str:
    return rf"CASE WHEN {_strip(x)} = '' THEN 0 ELSE len(string_split_regex({_strip(x)}, '[{WS}]+')) END"


def _weight(n: str) -> str:
    return f"least(0.75, 0.25 + 0.5 * (1 / (1 + exp(-0.9 * ({n} - 4))) - 1 / (1 + exp(2.7))))"


SENT_AT = "(TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (doc_id % 30))"
MAILS = f"""
mails AS (SELECT CASE WHEN doc_id % 4 = 0 THEN 'sent' ELSE 'inbox' END AS folder, doc_id AS Id,
  split_part(text, chr(10), 1) AS subject, text AS body,
  'Customer#' || lpad(CAST(doc_id % 150 AS VARCHAR), 9, '0') AS sender, source AS cc,
  {SENT_AT} AS date_sent FROM documents)"""
PEOPLE = """
emails AS (SELECT Id, subject, body, sender, lower(sender) AS alias, cc,
  strftime(date_sent, '%A, %B %-d, %Y %I:%M %p') AS sent_text, date_sent FROM mails),
receivers AS (SELECT o_orderkey // 3 AS EmailId, o_custkey % 25 AS PersonId, o_orderkey AS ord FROM orders),
aliases AS (SELECT lower(c_name) AS alias, CAST(c_nationkey AS BIGINT) AS PersonId, c_custkey AS ord FROM customer),
persons AS (SELECT CAST(n_nationkey AS BIGINT) AS Id, n_name AS Name FROM nation),
owners AS (SELECT Id FROM persons WHERE regexp_matches(Name, '(?i)nation_7$'))"""
BOXES = """
inbox AS (SELECT * FROM emails WHERE Id IN (SELECT EmailId FROM receivers WHERE PersonId IN (FROM owners))),
sent AS (SELECT * FROM emails WHERE alias IN (SELECT alias FROM aliases WHERE PersonId IN (FROM owners))),
rec AS (SELECT EmailId AS Id, string_agg(Name, '|' ORDER BY ord) AS names
  FROM receivers r JOIN persons p ON r.PersonId = p.Id GROUP BY EmailId),
boxes AS (SELECT 'inbox' AS folder, * FROM inbox UNION ALL SELECT 'sent', * FROM sent)"""
BENCH = """
q AS (SELECT item_id AS qid, text AS query, item_id // 4 AS set_id,
  CASE WHEN item_id // 4 % 2 = 0 THEN 'even' ELSE 'odd' END AS grp FROM benchmark)"""
VARIANTS = """
vr AS (SELECT qid, min(variant_no) AS variant_no, lower(v) AS variant FROM (
  SELECT item_id AS qid, 0 AS variant_no, text AS v FROM benchmark
  UNION ALL SELECT item_id, 1, upper(text) FROM benchmark
  UNION ALL SELECT a.item_id, 2, a.text || ' ' || b.text FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1)
  GROUP BY qid, lower(v))"""
NAMED = """
named AS (SELECT item_id AS qid,
  text || ' from ' || n_name || ' on January ' || CAST(item_id % 28 + 1 AS VARCHAR) || ', 2024' AS full_query,
  make_timestamp(2024, 1, item_id % 28 + 1, 0, 0, 0) AS start_date,
  make_timestamp(2024, 1, item_id % 28 + 1, 0, 0, 0) + INTERVAL 1 MONTH AS end_date
  FROM benchmark JOIN nation ON n_nationkey = item_id % 25),
q AS (SELECT *, array_to_string(list_filter(regexp_extract_all(full_query, '{pat}'),
  lambda w: regexp_full_match(w, '\\p{{L}}+') AND lower(w) NOT IN ({stop})), ' ') AS query,
  list_filter(regexp_extract_all(full_query, '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])from\\s+([\\p{{L}}\\p{{N}}_]+)', 1),
  lambda w: regexp_matches(w, '\\p{{L}}') AND lower(w) NOT IN ({stop}))[1] AS sender FROM named)"""
POSTINGS = f"""
tok AS (SELECT folder, Id, 'subject' AS field, {_tokens('subject')} AS t FROM mails
  UNION ALL SELECT folder, Id, 'body', {_tokens('body')} FROM mails
  UNION ALL SELECT folder, Id, 'sender', {_tokens('sender')} FROM mails),
flen AS (SELECT folder, field, Id, len(t) AS len FROM tok WHERE len(t) > 0),
post AS (SELECT folder, field, term, Id, count(*) AS tf
  FROM (SELECT folder, field, Id, unnest(t) AS term FROM tok) GROUP BY ALL),
fstat AS (SELECT folder, field, count(*) AS n_docs, avg(len) AS avg_len FROM flen GROUP BY ALL),
dfs AS (SELECT folder, field, term, count(*) AS df FROM post GROUP BY ALL)"""


def _bm25(name: str, terms: str, fields: str) -> str:
    """BM25 sums of a query-term table by mail and field."""
    return f"""
{name} AS (SELECT p.folder, t.qid, p.field, p.Id,
  sum(t.weight * ln(1 + (s.n_docs - d.df + 0.5) / (d.df + 0.5)) * 2.2 * p.tf
    / (p.tf + 1.2 * (0.25 + 0.75 * l.len / s.avg_len))) AS score
  FROM {terms} t JOIN post p ON p.term = t.term AND p.field IN ({fields})
  JOIN flen l ON l.folder = p.folder AND l.field = p.field AND l.Id = p.Id
  JOIN fstat s ON s.folder = p.folder AND s.field = p.field
  JOIN dfs d ON d.folder = p.folder AND d.field = p.field AND d.term = p.term
  GROUP BY ALL)"""


TERMS = f"""
qt AS (SELECT qid, term, count(*) AS weight FROM (SELECT qid, unnest({_tokens('query')}) AS term FROM q) GROUP BY ALL)"""
HITS = (
    TERMS
    + ","
    + _bm25("bm", "qt", "'subject', 'body'")
    + """,
best AS (SELECT folder, qid, Id, max(score) AS score FROM bm GROUP BY ALL)"""
)
SENDERS = (
    f"""
names AS (SELECT n_name AS Name, lower(c_name) AS alias FROM customer JOIN nation ON c_nationkey = n_nationkey),
st AS (SELECT q.qid, term, count(*) * 2.0 AS weight FROM q JOIN
  (SELECT Name, unnest({_tokens('alias')}) AS term FROM names) n ON n.Name = q.sender GROUP BY ALL),"""
    + _bm25("sb", "st", "'sender'")
)
BOOSTED = """
boosted AS (SELECT b.folder, b.qid, b.Id, b.score AS best, coalesce(s.score, 0) AS sender,
  CASE WHEN m.date_sent >= q.start_date AND m.date_sent < q.end_date THEN 1.5 ELSE 0 END AS bonus
  FROM best b JOIN q USING (qid) JOIN mails m ON m.folder = b.folder AND m.Id = b.Id
  LEFT JOIN sb s ON s.folder = b.folder AND s.qid = b.qid AND s.Id = b.Id)"""


def _hashed(name: str, rows: str, keys: str, text: str, extra: str = "") -> str:
    """Hashed bag-of-words vectors of length 64."""
    first = keys.split(", ")[-1]
    on = " AND ".join(f"c.{k} = r.{k}" for k in keys.split(", "))
    return f"""
{name}_c AS (SELECT {keys}, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 64 AS b, count(*) AS c
  FROM (SELECT {keys}, unnest({_tokens(text)}) AS term FROM {rows}) GROUP BY ALL),
{name}_n AS (SELECT {keys}, sqrt(sum(c * c)) AS n FROM {name}_c GROUP BY ALL),
{name} AS (SELECT {', '.join('r.' + k for k in keys.split(', '))},
  list(CAST(coalesce(c.c, 0) / coalesce(n.n, 1e-12) AS FLOAT) ORDER BY g.b) AS v
  FROM {rows} r CROSS JOIN (SELECT unnest(range(64)) AS b) g
  LEFT JOIN {name}_c c ON {on} AND c.b = g.b
  LEFT JOIN {name}_n n ON {on.replace('c.', 'n.')} GROUP BY ALL)"""


def _ranked(scores: str, parts: str) -> str:
    return f"(SELECT *, row_number() OVER (PARTITION BY {parts} ORDER BY {TIE} DESC, Id) - 1 AS rank FROM {scores})"


def _fuse(queries: str, vectors: str) -> str:
    """Exhaustive inner products, rank per variant, fused score."""
    return f"""
prod AS (SELECT v.folder, q.qid, q.variant_no, v.Id,
  list_dot_product(q.v::DOUBLE[], v.v::DOUBLE[]) AS score FROM {queries} q CROSS JOIN {vectors} v),
sem AS (SELECT folder, qid, Id, sum(1.0 / (61 + rank)) AS score
  FROM {_ranked('prod', 'folder, qid, variant_no')} GROUP BY ALL)"""


SEMANTIC = (
    _hashed("mv", "mails", "folder, Id", "subject || chr(10) || body")
    + ","
    + _hashed("qv", "vr", "qid, variant_no", "variant")
    + ","
    + _fuse("qv", "mv")
)
NO_ROWS = "(SELECT 'x' AS folder, 0 AS qid, 0 AS Id, 0.0 AS score WHERE false)"


def _combined(sem: str, kw: str) -> str:
    """Dense fill of both lists with 0, scaling and blending as first written down."""
    return f"""
filled AS (SELECT m.folder, q.qid, m.Id, coalesce(s.score, 0) AS s, coalesce(k.score, 0) AS k,
  s.score IS NOT NULL AS in_s, k.score IS NOT NULL AS in_k, {_weight(_length('q.query'))} AS lw
  FROM mails m CROSS JOIN q
  LEFT JOIN {sem} s ON s.folder = m.folder AND s.qid = q.qid AND s.Id = m.Id
  LEFT JOIN {kw} k ON k.folder = m.folder AND k.qid = q.qid AND k.Id = m.Id),
bounds AS (SELECT folder, qid, min(s) AS s0, max(s) AS s1, min(k) AS k0, max(k) AS k1,
  bool_or(in_s) AS has_s, bool_or(in_k) AS has_k, max(lw) AS lw FROM filled GROUP BY ALL),
combined AS (SELECT f.folder, f.qid, f.Id, w * CASE WHEN s1 = s0 THEN 0 ELSE (s - s0) / (s1 - s0) END
  + (1 - w) * CASE WHEN k1 = k0 THEN 0 ELSE (k - k0) / (k1 - k0) END AS score
  FROM filled f JOIN (SELECT *, CASE WHEN has_s AND has_k THEN lw WHEN has_s THEN 1 ELSE 0 END AS w
    FROM bounds WHERE has_s OR has_k) b ON b.folder = f.folder AND b.qid = f.qid),
result AS {_ranked('combined', 'folder, qid')}"""


RESULT = "SELECT folder, qid, Id, round(score, 6) AS score, rank FROM result"
KW_CHAIN = ",".join([MAILS, BENCH, POSTINGS, HITS])
W_SQL = """
pm AS (SELECT folder, set_id, Id, var_pop(rank) AS v, exp(-min(rank) / 20.0) AS w FROM rk GROUP BY ALL),
kw_w AS (SELECT folder, set_id, greatest(0, least(1, 1 - sum(w * v) / sum(w) /
  CASE WHEN count(*) > 1 THEN (count(*) ** 2 - 1) / 12 ELSE 1 END)) AS kendalls_w FROM pm GROUP BY ALL),
pairs AS (SELECT a.folder, a.set_id, exp(-least(a.rank, b.rank) / 20.0) AS w, (a.score - b.score) ** 2 AS e
  FROM rk a JOIN rk b ON a.folder = b.folder AND a.set_id = b.set_id AND a.Id = b.Id AND a.qid < b.qid),
mse AS (SELECT folder, set_id, least(1, sum(w * e) / sum(w)) AS pairwise_mse FROM pairs GROUP BY ALL)"""
EMAIL_TEXT = """
  || 'Result ' || CAST(rank + 1 AS VARCHAR) || chr(10) || '______________________' || chr(10)
  || 'Email ID: ' || CAST(m.Id AS VARCHAR) || chr(10)
  || CASE WHEN m.folder = 'inbox' THEN 'From: ' ELSE 'To: ' END || m.sender || chr(10)
  || 'CC''d: ' || m.cc || chr(10) || 'Date: ' || strftime(m.date_sent, '%Y-%m-%dT%H:%M:%S') || chr(10)
  || 'Subject: ' || left(CASE WHEN m.subject = '' THEN 'No Subject' ELSE m.subject END, 80) || chr(10)
  || 'Body Preview: ' || left(CASE WHEN m.body = '' THEN '[No Body Content]' ELSE m.body END, 1000) || chr(10) || chr(10)"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL."""
    stop = _stopwords()
    named = NAMED.format(pat=PAT, stop=stop)
    kw_named = ",".join([MAILS, named, POSTINGS, HITS])
    boosted = ",".join([kw_named, SENDERS, BOOSTED])
    # A search parses its queries: words are filtered, and no sender or date is named.
    parsed = BENCH.replace("q AS", "q0 AS") + f""",
q AS (SELECT qid, set_id, grp, query AS raw, CASE WHEN kept = '' THEN lower({_strip('query')}) ELSE kept END AS query FROM (
  SELECT *, array_to_string(list_filter(regexp_extract_all(query, '{PAT}'),
    lambda w: regexp_full_match(w, '\\p{{L}}+') AND lower(w) NOT IN ({stop})), ' ') AS kept FROM q0))"""
    kw_parsed = ",".join([MAILS, parsed, POSTINGS, HITS])
    full_text = lambda sql: sql.replace("_length", "").replace("q.query", "q.raw")
    kw_search = ",".join([kw_parsed, full_text(_combined(NO_ROWS, "best"))])
    hybrid = ",".join([kw_parsed, VARIANTS, SEMANTIC, full_text(_combined("sem", "best"))])
    semantic = ",".join([MAILS, BENCH, VARIANTS, SEMANTIC, _combined("sem", NO_ROWS)])
    ranked = kw_search + ",\nrk AS (SELECT r.*, q.set_id, q.grp FROM result r JOIN q USING (qid))"
    hybrid_ranked = hybrid + ",\nrk AS (SELECT r.*, q.set_id, q.grp FROM result r JOIN q USING (qid))"
    best4 = ranked + """,
b4 AS (SELECT folder, set_id, Id, max(score) AS score, arg_min(qid, rank_in) AS qid FROM (
  SELECT *, row_number() OVER (PARTITION BY folder, set_id, Id ORDER BY score DESC, qid) AS rank_in FROM rk) GROUP BY ALL),
best4 AS (SELECT *, row_number() OVER (PARTITION BY folder, set_id
  ORDER BY """ + TIE + """ DESC, CAST(Id AS VARCHAR)) - 1 AS rank FROM b4)"""
    given = """
ev AS (SELECT CASE WHEN vec_id % 4 = 0 THEN 'sent' ELSE 'inbox' END AS folder, vec_id AS Id, embedding AS v FROM embeddings),
eq AS (SELECT vec_id // 4 AS qid, vec_id % 4 AS variant_no, embedding AS v FROM embeddings)"""
    event_text = """CASE event_id % 5 WHEN 0 THEN strftime(ts, '%A, %B %-d, %Y %I:%M %p')
  WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN strftime(ts, '%-m/%-d/%Y')
  WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE event_type || ' OM' END"""
    event_time = """CASE event_id % 5 WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN date_trunc('second', ts)
  WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('second', ts) END"""
    repaired = rf"regexp_replace(regexp_replace({event_text}, '(^|[^\p{{L}}\p{{N}}_])[A-Z]{{1,3}}$', '\1'), '(^|[^\p{{L}}\p{{N}}_])OM([^\p{{L}}\p{{N}}_]|$)', '\1AM\2', 'g')"
    half_day = f"""CASE event_id % 5 WHEN 0 THEN date_trunc('day', ts) + INTERVAL 1 MINUTE * (
  CASE hour(ts) % 12 WHEN 0 THEN 12 ELSE hour(ts) % 12 END * 60 + minute(ts)) ELSE {event_time} END"""
    letters = " UNION ALL ".join(
        f"SELECT {i} AS pos, '{c}' AS c" for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")
    )

    def letter_vectors(rows: str, keys: str) -> str:
        return f"""WITH x AS ({rows}), l AS ({letters}),
n AS (SELECT {keys}, pos, len(text) - len(replace(text, c, '')) AS k FROM x CROSS JOIN l)
SELECT {keys}, CAST(pos AS BIGINT) AS pos, round(CAST(CAST(k / greatest(sqrt(sum(k * k) OVER (PARTITION BY {keys})), 1e-12) AS FLOAT) AS DOUBLE), 5) + 0.0 AS value FROM n"""

    date_sql = """WITH s AS (SELECT o_orderkey AS qid, CASE o_orderkey % 5 WHEN 0 THEN o_orderdate::DATE WHEN 1 THEN o_orderdate::DATE
WHEN 2 THEN date_trunc('month', o_orderdate)::DATE
WHEN 3 THEN make_date(CASE WHEN month(o_orderdate) < 12 THEN 1998 ELSE 1997 END, month(o_orderdate), 1)
ELSE date_trunc('year', o_orderdate)::DATE END AS d FROM orders)
SELECT qid, strftime(d, '%Y-%m-%d') AS start_date, strftime(d + INTERVAL 1 MONTH, '%Y-%m-%d') AS end_date FROM s"""
    sql = {
        "tokens": f"SELECT doc_id, len({_tokens('text')}) AS n_tokens, md5(array_to_string({_tokens('text')}, ' ')) AS words_md5 FROM documents",
        "clean_body": f"""SELECT 'document' AS kind, doc_id AS id, {_clean_body('text')} AS body FROM documents
UNION ALL SELECT 'page', page_id, {_clean_body('html')} FROM pages""",
        "clean_subject": f"""WITH {MAILS} SELECT Id, {_words_only('subject')} AS subject,
{_words_only("'RE:  ' || subject")} AS reply, {_words_only('subject')} AS stripped FROM mails""",
        "extract_alias": f"""SELECT doc_id, {_alias('text')} AS alias,
{_alias("source || ' < ' || text || '> x'")} AS angled FROM documents""",
        "iso_date": f"SELECT event_id, strftime({event_time}, '%Y-%m-%dT%H:%M:%S') AS iso FROM events",
        "date_repair": f"SELECT event_id, {repaired} AS repaired, strftime({half_day}, '%Y-%m-%dT%H:%M:%S') AS iso FROM events",
        "compose_text": f"""WITH {MAILS} SELECT Id, CASE WHEN Id % 3 = 0 THEN '' ELSE subject END || chr(10) || body AS text FROM mails""",
        "query_len_weight": f"""WITH x AS (SELECT 'document' AS kind, doc_id AS id, text FROM documents
UNION ALL SELECT 'customer', c_custkey, repeat(c_mktsegment || '  ', c_custkey % 12) FROM customer),
n AS (SELECT kind, id, {_length('text')} AS n_words FROM x)
SELECT kind, id, n_words, round({_weight('n_words')}, 6) AS weight FROM n""",
        "query_prompt": f"""SELECT item_id AS qid, 'Instruct: {tx.QUERY_TASK}' || chr(10) || 'Query: ' || text AS prompt FROM benchmark""",
        "hash_encode": f"""WITH {_hashed('dv', 'documents', 'doc_id', 'text')}
SELECT doc_id, generate_subscripts(v, 1) - 1 AS pos, round(CAST(unnest(v) AS DOUBLE), 6) AS value FROM dv""",
        "owner_flag": "SELECT CAST(n_nationkey AS BIGINT) AS Id, regexp_matches(n_name, '(?i)nation_7$') AS owner FROM nation",
        "alias_names": """WITH a AS (SELECT lower(c_name) AS Alias, c_nationkey AS p, c_custkey AS ord FROM customer
UNION ALL SELECT lower(c_name), (c_nationkey + 1) % 25, c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 1000000000 ELSE -1000000000 END FROM customer)
SELECT Alias, arg_max(n_name, ord) AS Name FROM a JOIN nation ON p = n_nationkey GROUP BY Alias""",
        "name_aliases": """SELECT n_name AS Name, count(*) AS n, string_agg(lower(c_name), '|' ORDER BY c_custkey) AS aliases
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
        "recipients": f"WITH {MAILS}, {PEOPLE}, {BOXES} SELECT Id AS EmailId, names FROM rec",
        "sender_names": f"""WITH {MAILS}, {PEOPLE}, s AS (SELECT Id, CASE WHEN Id % 7 = 0 THEN '' ELSE sender END AS ExtractedFrom FROM emails)
SELECT s.Id, ExtractedFrom, lower(ExtractedFrom) AS CleanedAlias, p.Name AS SenderName
FROM s LEFT JOIN aliases a ON a.alias = lower(ExtractedFrom) LEFT JOIN persons p ON p.Id = a.PersonId""",
        "inbox_mails": f"WITH {MAILS}, {PEOPLE}, {BOXES} SELECT Id FROM inbox",
        "sent_mails": f"WITH {MAILS}, {PEOPLE}, {BOXES} SELECT Id, alias AS CleanedAlias FROM sent",
        "mailboxes": f"""WITH {MAILS}, {PEOPLE}, {BOXES}
SELECT folder, b.Id, subject AS ExtractedSubject, body AS ExtractedBodyText, sender AS ExtractedFrom,
names AS ExtractedTo, cc AS ExtractedCc, sent_text AS ExtractedDateSent FROM boxes b LEFT JOIN rec USING (Id)""",
        "mailboxes_clean": f"""WITH {MAILS}, {PEOPLE}, {BOXES}
SELECT folder, b.Id, {_words_only('subject')} AS subject, md5({_clean_body('body')}) AS body_md5,
strftime(date_sent, '%Y-%m-%d 12:%M') AS date, b.alias AS CleanedAlias, p.Name AS SenderName
FROM boxes b LEFT JOIN aliases a ON a.alias = b.alias LEFT JOIN persons p ON p.Id = a.PersonId""",
        "mailbox_stats": f"WITH {MAILS}, {PEOPLE}, {BOXES} SELECT folder, count(*) AS n_mails FROM boxes GROUP BY folder",
        "corpus": f"""WITH {MAILS}, {PEOPLE}, {BOXES}
SELECT min(folder) AS folder, Id, md5(any_value(body)) AS body_md5,
strftime(any_value(date_sent), '%Y-%m-%dT%H:%M:%S') AS ExtractedDateSent FROM boxes GROUP BY Id""",
        "doc_numbers": f"WITH {MAILS} SELECT folder, Id, row_number() OVER (PARTITION BY folder ORDER BY Id) AS doc_no FROM mails",
        "raw_csv": f"""WITH {MAILS}, {PEOPLE}
SELECT 'Emails' AS source, Id AS a, md5(concat_ws('|', subject, body, sent_text)) AS b FROM emails
UNION ALL SELECT 'EmailReceivers', EmailId, CAST(PersonId AS VARCHAR) FROM receivers
UNION ALL SELECT 'Aliases', CAST(c_nationkey AS BIGINT), c_name FROM customer
UNION ALL SELECT 'Persons', Id, Name FROM persons""",
        "postings": f"WITH {MAILS}, {POSTINGS} SELECT folder, field, term, Id, tf, len FROM post JOIN flen USING (folder, field, Id)",
        "postings_exact": f"""WITH {MAILS} SELECT folder, 'cc' AS field, cc AS value, Id FROM mails WHERE cc IS NOT NULL
UNION ALL SELECT folder, 'recipients', sender, Id FROM mails UNION ALL SELECT folder, 'recipients', cc, Id FROM mails WHERE cc IS NOT NULL
UNION ALL SELECT folder, 'sender', lower(sender), Id FROM mails
UNION ALL SELECT folder, 'date_sent', strftime(date_sent, '%Y-%m-%dT%H:%M:%S'), Id FROM mails WHERE date_sent IS NOT NULL""",
        "term_stats": f"WITH {MAILS}, {POSTINGS} SELECT * FROM dfs",
        "field_stats": f"WITH {MAILS}, {POSTINGS} SELECT folder, field, n_docs, round(avg_len, 6) AS avg_len FROM fstat",
        "bm25_scores": f"WITH {KW_CHAIN} SELECT folder, qid, field, Id, round(score, 6) AS score FROM bm",
        "bm25_best_field_top10": f"""WITH {KW_CHAIN} SELECT r.folder, qid, rank, r.Id, round(score, 6) AS score, subject AS ExtractedSubject
FROM {_ranked('best', 'folder, qid')} r JOIN mails m ON m.folder = r.folder AND m.Id = r.Id WHERE rank < 10""",
        "sender_boost": f"WITH {boosted} SELECT folder, qid, Id, round(best, 6) AS best, round(sender, 6) AS sender FROM boosted",
        "keyword_boosted": f"WITH {boosted} SELECT folder, qid, Id, round(best + sender + bonus, 6) AS score FROM boosted",
        "keyword_as_run": f"WITH {kw_named} SELECT folder, qid, Id, round(score, 6) AS score FROM best",
        "keyword_filtered": f"""WITH {boosted} SELECT b.folder, b.qid, b.Id, round(best, 6) AS score FROM boosted b
JOIN q USING (qid) JOIN mails m ON m.folder = b.folder AND m.Id = b.Id
WHERE bonus > 0 AND (q.sender NOT IN (SELECT Name FROM names)
  OR lower(m.sender) IN (SELECT alias FROM names n WHERE n.Name = q.sender))""",
        "hit_cap": f"""WITH {boosted}, c AS (SELECT folder, qid, Id, best + sender + bonus AS score FROM boosted)
SELECT folder, qid, Id, round(score, 6) AS score FROM c""",
        "l2_normalize": """WITH x AS (SELECT vec_id, unnest(range(64)) AS pos, embedding FROM embeddings),
y AS (SELECT vec_id, pos, CAST(embedding[pos + 1] AS DOUBLE) * 3 AS e FROM x)
SELECT vec_id, pos, round(CAST(CAST(e / sqrt(sum(e * e) OVER (PARTITION BY vec_id)) AS FLOAT) AS DOUBLE), 5) + 0.0 AS value FROM y""",
        "dense_top10": f"""WITH {given}, {_fuse('eq', 'ev')}
SELECT folder, qid, variant_no, Id, round(score, 6) AS score, rank FROM {_ranked('prod', 'folder, qid, variant_no')} WHERE rank < 10""",
        "rrf_fused": f"WITH {given}, {_fuse('eq', 'ev')} SELECT folder, qid, Id, round(score, 6) AS score FROM sem",
        "vector_table": f"""WITH {MAILS}, {_hashed('mv', 'mails', 'folder, Id', 'subject || chr(10) || body')}
SELECT folder, Id, len(v) AS dim, round(list_sum(v::DOUBLE[]), 5) + 0.0 AS total FROM mv""",
        "embed_model": letter_vectors("SELECT doc_id, text FROM documents", "doc_id"),
        "embed_queries_model": letter_vectors(
            f"WITH {VARIANTS} SELECT qid, CAST(variant_no AS BIGINT) AS variant_no, 'Instruct: {tx.QUERY_TASK}' || chr(10) || 'Query: ' || variant AS text FROM vr",
            "qid, variant_no",
        ),
        "min_max": f"""WITH {KW_CHAIN} SELECT folder || '-' || CAST(qid AS VARCHAR) AS key, Id,
round(coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 0), 6) AS norm
FROM best WINDOW w AS (PARTITION BY folder, qid)""",
        "combined_top10": f"""WITH {KW_CHAIN}, {given},
es AS (SELECT v.folder, e.qid, v.Id, max(list_dot_product(e.v::DOUBLE[], v.v::DOUBLE[])) AS score
  FROM (SELECT vec_id % (SELECT count(*) FROM q) AS qid, embedding AS v FROM embeddings) e
  CROSS JOIN ev v WHERE v.Id IN (SELECT Id FROM mails) GROUP BY ALL),
{_combined('es', 'best')} {RESULT} WHERE rank < 10""",
        "full_ranking": f"""WITH {KW_CHAIN} SELECT folder, qid, Id, round(score, 6) AS score, rank FROM {_ranked('best', 'folder, qid')}""",
        "search_semantic": f"WITH {semantic} {RESULT} WHERE rank < 10",
        "search_keyword": f"WITH {kw_search} {RESULT} WHERE rank < 10",
        "search_hybrid": f"WITH {hybrid} {RESULT} WHERE rank < 10",
        "search_hybrid_full": f"WITH {hybrid} {RESULT}",
        "sender_alias": """WITH n AS (SELECT n_name AS Name, count(*) AS n, md5(string_agg(lower(c_name), '|' ORDER BY c_custkey)) AS m
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
s AS (SELECT o_orderkey AS qid, 'NATION_' || CAST(o_custkey % 30 AS VARCHAR) AS sender FROM orders)
SELECT qid, sender, n, m AS aliases_md5 FROM s LEFT JOIN n ON Name = sender""",
        "sender_by_word": "SELECT lower(n_name) AS Name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
        "date_range": date_sql,
        "date_forms": """WITH s AS (SELECT o_orderkey AS qid, o_orderdate::DATE AS o, CASE o_orderkey % 14 WHEN 0 THEN o_orderdate::DATE
WHEN 1 THEN o_orderdate::DATE WHEN 2 THEN o_orderdate::DATE WHEN 3 THEN date_trunc('month', o_orderdate)::DATE
WHEN 4 THEN make_date(1998, month(o_orderdate), least(day(o_orderdate), day(last_day(make_date(1998, month(o_orderdate), 1)))))
WHEN 5 THEN make_date(1998, month(o_orderdate), least(day(o_orderdate), day(last_day(make_date(1998, month(o_orderdate), 1)))))
WHEN 6 THEN DATE '1998-12-08' WHEN 7 THEN DATE '1998-11-15' WHEN 8 THEN DATE '1997-12-15' WHEN 9 THEN DATE '1998-12-14'
WHEN 10 THEN DATE '1998-12-15' WHEN 11 THEN make_date(CASE WHEN month(o_orderdate) < 12 THEN 1998 ELSE 1997 END, month(o_orderdate), 1)
WHEN 12 THEN o_orderdate::DATE ELSE DATE '2012-01-01' END AS d, o_orderkey % 14 IN (4, 5) AND month(o_orderdate) = 2 AND day(o_orderdate) = 29 AS leap FROM orders)
SELECT qid, CASE WHEN NOT leap THEN strftime(d, '%Y-%m-%d') END AS start_date,
CASE WHEN NOT leap THEN strftime(d + INTERVAL 1 MONTH, '%Y-%m-%d') END AS end_date FROM s""",
        "parsed_queries": f"""WITH s AS ({date_sql}),
n AS (SELECT n_name AS Name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
x AS (SELECT o_orderkey AS qid, 'NATION_' || CAST(o_custkey % 30 AS VARCHAR) AS sender,
  'Mail priority ' || array_to_string(list_filter(regexp_extract_all(o_orderpriority, '{PAT}'),
    lambda w: regexp_full_match(w, '\\p{{L}}+') AND lower(w) NOT IN ({stop})), ' ')
  || CASE o_orderkey % 5 WHEN 3 THEN ' last' ELSE '' END
  || CASE WHEN o_orderkey % 5 IN (1, 2, 3) AND month(o_orderdate) <> 0 THEN ' ' || monthname(o_orderdate) ELSE '' END AS relevant_text
  FROM orders)
SELECT x.qid, relevant_text, start_date, end_date, n AS n_senders FROM x JOIN s USING (qid) LEFT JOIN n ON n.Name = x.sender""",
        "keyword_by_word": f"""WITH {boosted.replace("n.Name = q.sender", "lower(n.Name) = lower(q.sender)")}
SELECT folder, qid, Id, round(best + sender + bonus, 6) AS score FROM boosted""",
        "relevant_text": f"WITH {named} SELECT qid, query AS relevant_text FROM q",
        "variants": f"WITH {VARIANTS} SELECT qid, CAST(variant_no AS BIGINT) AS variant_no, variant FROM vr",
        "variants_generated": """SELECT item_id AS qid, CAST(0 AS BIGINT) AS variant_no, lower(text) AS variant FROM benchmark
UNION ALL SELECT item_id, 2, lower(text) || ' ' || lower(text) FROM benchmark""",
        "best4_across": f"WITH {best4} SELECT folder, set_id, Id, round(score, 6) AS score, qid, rank FROM best4 WHERE rank < 4",
        "kendalls_w": f"WITH {ranked}, {W_SQL} SELECT folder, set_id, round(kendalls_w, 6) AS kendalls_w FROM kw_w",
        "metrics_with_empty_list": f"""WITH {ranked}, {W_SQL}, s AS (SELECT folder, set_id, count(DISTINCT qid) AS n,
count(DISTINCT Id) AS n_mails, count(*) AS n_rows FROM rk GROUP BY ALL)
SELECT folder, set_id, CASE WHEN set_id % 2 = 0 THEN 1.0 ELSE round(kendalls_w, 6) END AS kendalls_w,
n + CASE WHEN set_id % 2 = 0 THEN 1 ELSE 0 END AS n_lists, n_mails,
n_rows = (n + CASE WHEN set_id % 2 = 0 THEN 1 ELSE 0 END) * n_mails AS same_ids
FROM kw_w JOIN s USING (folder, set_id)""",
        "pairwise_mse": f"WITH {ranked}, {W_SQL} SELECT folder, set_id, round(pairwise_mse, 6) AS pairwise_mse FROM mse",
        "same_ids": f"""WITH {KW_CHAIN}, s AS (SELECT b.*, set_id FROM best b JOIN q USING (qid))
SELECT folder, set_id, count(DISTINCT qid) AS n_lists, count(DISTINCT Id) AS n_mails,
count(*) = count(DISTINCT qid) * count(DISTINCT Id) AS same_ids FROM s GROUP BY ALL""",
        "rank_decay": f"WITH {ranked} SELECT folder, qid, Id, round(exp(-rank / 20.0), 6) AS weight FROM rk",
        "metric_summary": f"""WITH {ranked}, {W_SQL} SELECT folder, grp AS "group", 'keyword' AS mode,
round(avg(kendalls_w), 6) AS kendalls_w_mean, round(stddev_samp(kendalls_w), 6) AS kendalls_w_std,
round(avg(pairwise_mse), 6) AS pairwise_mse_mean, round(stddev_samp(pairwise_mse), 6) AS pairwise_mse_std
FROM kw_w JOIN mse USING (folder, set_id) JOIN (SELECT DISTINCT set_id, grp FROM q) USING (set_id) GROUP BY folder, grp""",
        "evaluate_hybrid": f"""WITH {hybrid_ranked}, {W_SQL} SELECT folder, set_id, round(kendalls_w, 6) AS kendalls_w,
round(pairwise_mse, 6) AS pairwise_mse FROM kw_w JOIN mse USING (folder, set_id)""",
        "report": f"""WITH {kw_search}, top AS (SELECT * FROM result WHERE rank < 3)
SELECT t.folder, qid, rank, '' {EMAIL_TEXT} AS text FROM top t JOIN mails m ON m.folder = t.folder AND m.Id = t.Id
UNION ALL SELECT DISTINCT folder, t.qid, -1, chr(10) || '~~~~~~~~~~~~ QUERY #' || CAST(t.qid AS VARCHAR) || ' ~~~~~~~~~~~~' || chr(10)
|| 'Folder: ' || folder || chr(10) || 'Query: ' || q.raw || chr(10) || chr(10) FROM top t JOIN q USING (qid)""",
        "search_numbered": f"""WITH {kw_search},
d AS (SELECT folder, Id, row_number() OVER (PARTITION BY folder ORDER BY Id) AS doc_no FROM mails)
SELECT r.folder, qid, rank, r.Id, doc_no FROM result r JOIN d ON d.folder = r.folder AND d.Id = r.Id WHERE rank < 5""",
        "set_report": f"""WITH {best4}, top AS (SELECT * FROM best4 WHERE rank < 4),
lines AS (SELECT set_id, string_agg('Query ' || CAST(qid % 4 + 1 AS VARCHAR) || ': ' || raw || chr(10), '' ORDER BY qid) AS l FROM q GROUP BY set_id)
SELECT t.folder, set_id, rank, '' {EMAIL_TEXT} AS text FROM top t JOIN mails m ON m.folder = t.folder AND m.Id = t.Id
UNION ALL SELECT DISTINCT folder, t.set_id, -1, chr(10) || '~~~~~~~~~~~~ QUERY SET #' || CAST(t.set_id AS VARCHAR) || ' ~~~~~~~~~~~~' || chr(10)
|| 'Folder: ' || folder || chr(10) || l || 'Top 4 distinct results across queries: ' || chr(10) FROM top t JOIN lines USING (set_id)""",
    }
    sql["report_file"] = f"""WITH report AS ({sql['report']})
, parts AS (SELECT 1 AS part, * FROM report UNION ALL SELECT 2, * FROM report WHERE rank < 0),
cut AS (SELECT part, folder, qid, rank, string_split(text, chr(10)) AS l FROM parts),
lines AS (SELECT part, folder, qid, rank, l, unnest(range(len(l))) AS i FROM cut)
SELECT row_number() OVER (ORDER BY part, folder, qid, rank, i) - 1 AS line_no, l[i + 1] AS line FROM lines"""
    return sql | (llm.oracle_sql() if llm else {})
