import math

import pytest
from pyspark.sql import functions as F

from mailweave.operators.keyword import bm25, keyword_search, match_best_field, sender_terms
from mailweave.operators.query_parse import by_name_word, expand_queries, parse_queries, resolve_sender
from mailweave.operators.ranking import hit_cap
from mailweave.plans.evaluation import evaluate
from mailweave.plans.search import fetch, open_store, search, search_scores, semantic_search
from mailweave.sources import reports
from mailweave.sources.postings import build_postings, corpus_stats, load_index, stored_index, write_index

MAILS = [
    ("inbox", 1, "gratitude", "thanks for the praise thanks", "alice@corp.com", "2012-12-05"),
    ("inbox", 2, "crisis report", "bombings and crises in the city", "bob@corp.com", "2012-11-05"),
    ("inbox", 3, "talk", "will you be able to talk soon", "alice@corp.com", None),
    ("inbox", 4, "", "plans to talk about the crisis", None, "2012-12-31"),
    ("sent", 5, "thanks", "praise and gratitude", "me@corp.com", "2012-12-01"),
]
ALIASES = [("Alice", "alice@corp.com"), ("Alice", "ally"), ("Bob Hope", "bob@corp.com")]


@pytest.fixture(scope="module")
def corpus(spark):
    columns = "folder string, Id bigint, ExtractedSubject string, ExtractedBodyText string, ExtractedFrom string, d string"
    df = spark.createDataFrame(MAILS, columns)
    return df.select(
        "*",
        F.col("d").alias("ExtractedDateSent"),
        F.col("d").cast("timestamp_ntz").alias("date_sent"),
        F.lit(None).cast("string").alias("ExtractedCc"),
        F.array(F.lit("x"), F.lit("y")).alias("ExtractedTo"),
    ).drop("d")


@pytest.fixture(scope="module")
def aliases(spark):
    return spark.createDataFrame(ALIASES, "Name string, Alias string")


@pytest.fixture(scope="module")
def store(spark, corpus, aliases):
    return open_store(corpus, aliases)


def asked(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid bigint, query string")


def brute_bm25(query, folder, field):
    texts = {m[1]: (m[2 if field == "subject" else 3] or "").lower().split() for m in MAILS if m[0] == folder}
    texts = {i: t for i, t in texts.items() if t}
    average = sum(map(len, texts.values())) / len(texts)
    out = {}
    for i, words in texts.items():
        total = 0.0
        for term in query.lower().split():
            df = sum(term in t for t in texts.values())
            tf = words.count(term)
            if tf:
                idf = math.log(1 + (len(texts) - df + 0.5) / (df + 0.5))
                total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / average))
        if total:
            out[(folder, field, i)] = round(total, 9)
    return out


QUERY = "thanks thanks talk crisis praise the"


def check_bm25(spark, index):
    got = {
        (r.folder, r.field, r.Id): round(r.score, 9)
        for r in bm25(asked(spark, QUERY), index).collect()
    }
    want = {}
    for folder in ("inbox", "sent"):
        for field in ("subject", "body"):
            want |= brute_bm25(QUERY, folder, field)
    assert got == want


def test_bm25_lazy_and_stored(spark, corpus):
    check_bm25(spark, build_postings(corpus))
    check_bm25(spark, stored_index(corpus))


def test_bm25_with_shuffled_joins(spark, corpus, tiny_broadcast):
    check_bm25(spark, stored_index(corpus))


def test_stored_postings_are_scored_without_shuffling_them(spark, store):
    plan = bm25(asked(spark, QUERY), store.index)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "hashpartitioning(folder" not in plan


def test_parse_queries(spark):
    texts = [
        "mail from Alice about Syria",
        "away from",
        "news from the Bob in December 2012",
        "on 2011-01-31",
        "the of and",
        "last March, or 2010",
        "2011-02-31 then 2012",
        "Bombings, crises!",
    ]
    rows = parse_queries(asked(spark, *texts), as_of="2012-06-15").orderBy("qid").collect()
    assert [r.sender for r in rows[:3]] == ["Alice", None, None]
    days = [(str(r.start_date)[:10], str(r.end_date)[:10]) for r in rows]
    assert days[2] == ("2012-12-01", "2013-01-01")
    assert days[3] == ("2011-01-31", "2011-02-28")
    assert days[5] == ("2012-03-01", "2012-04-01")
    assert rows[0].start_date is None and rows[6].start_date is None
    assert rows[0].relevant_text == "mail Alice Syria"
    assert rows[4].relevant_text == "the of and"
    assert rows[7].relevant_text == "Bombings crises"


def test_resolve_sender(spark, aliases):
    lists = aliases.groupBy("Name").agg(F.sort_array(F.collect_list("Alias")).alias("aliases"))
    parsed = parse_queries(asked(spark, "from Alice", "from Hope"))
    got = {r.qid: r.possible_senders for r in resolve_sender(parsed, lists).collect()}
    assert got == {0: ["alice@corp.com", "ally"], 1: None}
    words = {(r.Name, r.Alias) for r in by_name_word(aliases).collect()}
    assert ("hope", "bob@corp.com") in words


@pytest.mark.parametrize("large", [False, True])
def test_facts_of_a_sender_are_joined_without_the_list(spark, aliases, request, large):
    if large:
        request.getfixturevalue("tiny_broadcast")
    lists = aliases.groupBy("Name").agg(F.sort_array(F.collect_list("Alias")).alias("aliases"))
    parsed = parse_queries(asked(spark, "from Alice", "from Hope"))
    resolved = resolve_sender(parsed, lists.withColumn("n", F.size("aliases"))).select("qid", "n")
    assert {r.qid: r.n for r in resolved.collect()} == {0: 2, 1: None}
    plan = resolved._jdf.queryExecution().optimizedPlan()
    assert "possible_senders" not in plan.toString()


def test_boosts_only_add_to_hits(spark, store, aliases):
    parsed = parse_queries(asked(spark, "praise from Alice in December 2012"), as_of="2012-06-15")
    plain = {r.Id: r.score for r in keyword_search(parsed, store.index, aliases, boosts=False).collect()}
    boosted = {r.Id: r.score for r in keyword_search(parsed, store.index, aliases).collect()}
    assert set(plain) == set(boosted) == {1, 5}
    assert boosted[5] > plain[5] + 1.5 - 1e-9 and boosted[1] > plain[1] + 1.5
    kept = keyword_search(parsed, store.index, aliases, mode="filter", corpus=store.corpus).collect()
    assert [r.Id for r in kept] == [1]
    with pytest.raises(ValueError):
        keyword_search(parsed, store.index, mode="other")


def test_sender_by_word_of_the_name(spark, store, aliases):
    parsed = parse_queries(asked(spark, "crisis from hope"))
    exact, word = (
        {r.Id: r.score for r in keyword_search(parsed, store.index, aliases, match=m).collect()}
        for m in ("exact", "word")
    )
    assert word[2] > exact[2] and word[4] == exact[4]


def test_hit_cap(spark, store):
    parsed = parse_queries(asked(spark, "talk crisis"))
    assert keyword_search(parsed, store.index, max_hits=1).count() == 1
    assert search_scores(asked(spark, "talk crisis"), store, "inbox", "keyword", n=None, hits_only=True, max_hits=1).count() == 1
    folder = spark.range(700).select(F.lit("inbox").alias("folder"), "id")
    assert hit_cap(folder) == 700 and hit_cap(folder.limit(3)) == 500 and hit_cap(folder.limit(0)) == 500


def test_filter_mode_of_a_search(spark, store):
    queries = asked(spark, "praise from Alice in December 2012")
    found = search_scores(queries, store, mode="keyword", keyword_mode="filter", hits_only=True)
    assert [r.Id for r in found.collect()] == [1]


def test_last_month_follows_the_current_date(spark):
    row = parse_queries(asked(spark, "last March")).select(
        (F.year("start_date") - F.year(F.current_date()) + F.when(F.month(F.current_date()) > 3, 0).otherwise(1)).alias("d")
    )
    assert row.first().d == 0


def test_index_needs_dates_and_may_be_empty(spark, corpus):
    derived = build_postings(corpus.drop("date_sent").withColumn("ExtractedDateSent", F.lit("2012-12-05 10:00:00")))
    assert derived.postings.filter("date_sent is null").count() == 0
    with pytest.raises(ValueError):
        build_postings(corpus.drop("date_sent", "ExtractedDateSent"))
    empty = stored_index(corpus.filter("Id < 0"))
    assert bm25(asked(spark, QUERY), empty).count() == 0


def test_expand_queries(spark):
    queries = asked(spark, "Hello You", "b")
    variants = spark.createDataFrame(
        [(0, "HELLO you"), (0, "hi you"), (0, "hi you")], "qid bigint, variant string"
    )
    got = {(r.qid, r.variant) for r in expand_queries(queries, variants).collect()}
    assert got == {(0, "hello you"), (0, "hi you"), (1, "b")}
    made = expand_queries(queries, generator=lambda q: [q, q + "!"]).collect()
    assert {(r.qid, r.variant_no) for r in made} == {(0, 0), (0, 2), (1, 0), (1, 2)}


def test_modes_and_folders(spark, store):
    queries = asked(spark, "talk about crisis")
    with pytest.raises(ValueError):
        search_scores(queries, store, mode="best")
    with pytest.raises(ValueError):
        search_scores(queries, store, folder="drafts")
    found = search(queries, store, n=2, folder="inbox", mode="hybrid").collect()
    assert [r["rank"] for r in found] == [0, 1] and found[0].Id == 4
    assert {r.folder for r in found} == {"inbox"}


def test_no_keyword_hit_gives_semantic_scores(spark, store):
    queries = asked(spark, "zebra quagga")
    rows = lambda mode: [
        (r.folder, r.Id, r["rank"], r.score)
        for r in search_scores(queries, store, mode=mode, n=None).orderBy("folder", "rank").collect()
    ]
    assert rows("hybrid") == rows("semantic") and len(rows("hybrid")) == 5
    assert rows("keyword") == []


def test_variant_order_does_not_matter(spark, store):
    queries = asked(spark, "talk")
    pair = [(0, 1, "crisis in city"), (0, 2, "praise")]
    swapped = [(0, 2, "crisis in city"), (0, 1, "praise")]
    result = lambda rows: sorted(
        (r.folder, r.Id, round(r.score, 12))
        for r in semantic_search(
            queries, store.vectors, variants=spark.createDataFrame(rows, "qid bigint, variant_no int, variant string")
        ).collect()
    )
    assert result(pair) == result(swapped)


def test_search_in_shuffled_form(spark, store, tiny_broadcast, tiny_windows):
    queries = asked(spark, "talk about crisis", "thanks praise")
    shuffled = {(r.folder, r.qid, r.Id): (r["rank"], round(r.score, 9)) for r in search(queries, store, n=3).collect()}
    spark.conf.unset("spark.mailweave.broadcastBytes")
    spark.conf.unset("spark.mailweave.windowRows")
    plain = {(r.folder, r.qid, r.Id): (r["rank"], round(r.score, 9)) for r in search(queries, store, n=3).collect()}
    assert shuffled == plain and len(plain) == 2 * (3 + 1)


SETS = {
    1: ["thanks for the kind words", "a note of praise", "words of thanks", "kind praise for the staff"],
    2: ["crisis in the city", "trouble downtown", "the city in trouble", "talk of a crisis"],
    3: ["shall we talk", "a talk on Monday", "time for a talk", "talk later"],
    4: ["crisis in the city", "a note of praise", "shall we talk", "budget of next year"],
    5: ["what is new", "he thinks otherwise", "large events", "talk later"],
    6: ["about the harbour", "a note of praise", "when to meet", "an attached paper"],
}


def test_evaluate_query_sets(spark, store, tmp_path):
    rows = [
        ("similar" if s <= 3 else "different", s, 10 * s + i, text)
        for s, texts in SETS.items()
        for i, text in enumerate(texts)
    ]
    sets = spark.createDataFrame(rows, "group string, set_id bigint, qid bigint, query string")
    result = evaluate(sets, store, folder="inbox", mode="hybrid")
    metrics = result.metrics.collect()
    assert len(metrics) == 6
    assert all(0 <= r.kendalls_w <= 1 and 0 <= r.pairwise_mse <= 1 for r in metrics)
    assert result.ranked.count() == 24 * 4
    assert {r.group for r in result.summary.collect()} == {"similar", "different"}
    report = reports.format_set_results(result.best, sets)
    assert report.count() == 6 * (4 + 1)
    reports.write_report(report, str(tmp_path / "sets"), mode="overwrite")
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "sets")).collect())
    assert "~~~~~~~~~~~~ QUERY SET #1 ~~~~~~~~~~~~" in text and "Query 4: kind praise" in text


def test_sets_without_hits_agree(spark, store):
    sets = spark.createDataFrame(
        [("g", 1, 1, "zebra"), ("g", 1, 2, "quagga")], "group string, set_id bigint, qid bigint, query string"
    )
    row = evaluate(sets, store, folder="inbox", mode="keyword").metrics.first()
    assert (row.kendalls_w, row.pairwise_mse) == (1.0, 0.0)


def test_a_query_without_hits_beside_others_is_an_error(spark, store):
    sets = spark.createDataFrame(
        [("g", 1, 1, "zebra"), ("g", 1, 2, "talk")], "group string, set_id bigint, qid bigint, query string"
    )
    with pytest.raises(Exception, match="different mails"):
        evaluate(sets, store, folder="inbox", mode="keyword").metrics.collect()


def test_report_text(spark, store):
    queries = asked(spark, "talk crisis")
    report = reports.format_results(search(queries, store, n=1, mode="keyword"), queries)
    blocks = {(r.folder, r["rank"]): r.text for r in report.collect()}
    assert blocks[("inbox", -1)] == (
        "\n~~~~~~~~~~~~ QUERY #0 ~~~~~~~~~~~~\nFolder: inbox\nQuery: talk crisis\n\n"
    )
    assert blocks[("inbox", 0)].startswith("Result 1\n______________________\nEmail ID: ")
    assert "CC'd: None" in blocks[("inbox", 0)]


def test_report_of_sent_mail(spark, corpus):
    ranked = spark.createDataFrame([("sent", 0, 5, 1.0, 0)], "folder string, qid bigint, Id bigint, score double, rank bigint")
    text = reports.format_results(fetch(ranked, corpus, 1), asked(spark, "q")).filter("rank = 0").first().text
    assert "To: x, y\n" in text and "From:" not in text


def test_exact_values_of_a_mail(spark, corpus, tmp_path):
    from mailweave.sources.postings import exact_values, load_index, write_index

    wide = corpus.withColumn("ExtractedTo", F.expr("IF(Id = 1, array('Bob Hope', 'Ann', 'Bob Hope', null), null)")).withColumn(
        "ExtractedCc", F.expr("IF(Id = 2, 'A, B', null)")
    )
    rows = exact_values(wide).collect()
    by = lambda field: sorted((r.Id, r.value) for r in rows if r.field == field)
    assert by("recipients") == [(1, "Ann"), (1, "Bob Hope")] and by("cc") == [(2, "A, B")]
    assert len(by("sender")) == corpus.filter("ExtractedFrom IS NOT NULL").count()
    assert all(len(v) == 19 and v[10] == "T" for _, v in by("date_sent"))
    write_index(wide, str(tmp_path / "index"))
    back = load_index(spark, str(tmp_path / "index")).exact
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows))
    pushed = back.filter("field = 'sender' AND value = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(field,sender)" in pushed and "EqualTo(value,x)" in pushed
    write_index(wide.filter("1 = 0"), str(tmp_path / "none"))
    assert load_index(spark, str(tmp_path / "none")).exact.count() == 0


def test_many_allowed_mails_do_not_shuffle_postings(spark, store, aliases, monkeypatch):
    """Also an id that is in both folders, of which a query may find one."""
    from mailweave.operators import keyword

    parsed = parse_queries(asked(spark, "praise thanks talk", "praise talk crisis"))
    allowed = spark.createDataFrame([("inbox", 0, 1), ("inbox", 0, 3), ("sent", 0, 1), ("sent", 1, 5)], "folder string, qid long, Id long")
    few = keyword.match_best_field(parsed, store.index, text_col="relevant_text", allowed=allowed)
    want = {(r.folder, r.qid, r.Id): round(r.best, 9) for r in few.collect()}
    monkeypatch.setattr(keyword, "broadcast_limit", lambda df: 100)
    many = keyword.match_best_field(parsed, store.index, text_col="relevant_text", allowed=allowed)
    assert want and {(r.folder, r.qid, r.Id): round(r.best, 9) for r in many.collect()} == want
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = keyword.match_best_field(parsed, store.index, text_col="relevant_text", allowed=allowed)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    # Only the pairs, by id.
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "_id" in exchanges[0], plan


def test_filter_mode_scores_only_what_may_be_found(spark, store, aliases):
    parsed = parse_queries(asked(spark, "praise from Alice in December 2012"), as_of="2012-06-15")
    found = keyword_search(parsed, store.index, aliases, mode="filter")
    assert [r.Id for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The semi join lies below the aggregation of scores.
    assert 0 < plan.index("Aggregate") < plan.index("LeftSemi")
    named = keyword_search(parse_queries(asked(spark, "praise from Alice", "praise", "praise in 2012", "praise from Nobody")), store.index, aliases, mode="filter")
    plain = keyword_search(parse_queries(asked(spark, "praise", "praise")), store.index, aliases, boosts=False)
    all_hits = {r.Id: round(r.score, 9) for r in plain.filter("qid = 0").collect()}
    got = {}
    for r in named.collect():
        got.setdefault(r.qid, {})[r.Id] = round(r.score, 9)
    assert got[1] == all_hits and got[3] == {k: v for k, v in got[3].items()}
    assert all(all_hits[k] == v for k, v in got[0].items()) and 0 < len(got[0]) < len(all_hits) + 1


def test_positions_of_found_mails(spark, tiny_windows):
    from mailweave.operators.ranking import number_docs
    from mailweave.plans.search import positions

    corpus = spark.createDataFrame(
        [("inbox" if k % 3 else "sent", 7 * k % 101) for k in range(101)], "folder string, Id bigint"
    ).repartition(4)
    found = corpus.filter("Id % 9 < 2").withColumn("qid", F.lit(1)).union(corpus.limit(3).withColumn("qid", F.lit(2)))
    want = {(r.folder, r.Id): r.doc_no for r in number_docs(corpus).collect()}
    for rows in (100, 1 << 40):
        got = {(r.folder, r.Id): r.doc_no for r in positions(found, corpus, rows).collect()}
        assert got == {k: want[k] for k in got} and set(got) == {(r.folder, r.Id) for r in found.collect()}
    assert positions(found.filter("1 = 0"), corpus, 0).count() == 0


def test_report_parts_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = [("inbox", q, r, f"block {q}.{r}\nmore\n") for q in range(30) for r in (-1, 0, 1)]
    df = spark.createDataFrame(rows, "folder string, qid bigint, rank bigint, text string").repartition(7)
    lines = lambda part: [x for _, _, _, t in sorted(part, key=lambda r: r[1:3]) for x in t.split("\n")]
    read = lambda: [r.line for r in reports.read_report(spark, path).orderBy("line_no").collect()]
    assert reports.write_report(df, path, "append") == 1
    assert reports.write_report(df.filter("qid < 3"), path) == 2
    assert read() == lines(rows) + lines([r for r in rows if r[1] < 3])
    # A writer that fails leaves nothing, one that came first keeps its number.
    broken = df.withColumn("text", F.raise_error(F.lit("stop")))
    with pytest.raises(Exception, match="stop"):
        reports.write_report(broken, path)
    assert read() == lines(rows) + lines([r for r in rows if r[1] < 3])
    assert reports.write_report(df.filter("qid = 9"), path) > 2
    assert read()[-9:] == lines([r for r in rows if r[1] == 9])
    reports.write_report(df.filter("qid = 5"), path, "overwrite")
    assert read() == lines([r for r in rows if r[1] == 5])
    with pytest.raises(ValueError):
        reports.write_report(df, path, "ignore")


def test_saved_store(spark, corpus, aliases, tmp_path):
    from mailweave.plans.search import load_store, save_store

    path = str(tmp_path / "store")
    save_store(corpus, path, aliases)
    queries = asked(spark, "talk about crisis", "praise from Alice")
    rows = lambda s: [(r.folder, r.qid, r["rank"], r.Id, round(r.score, 6)) for r in search(queries, s, n=3).collect()]
    assert rows(load_store(corpus, path)) == rows(open_store(corpus, aliases))
    with pytest.raises(Exception):
        load_store(corpus, str(tmp_path / "none"))


def test_postings_of_few_words_are_read_by_literal_filters(spark, store, monkeypatch):
    from mailweave.operators import keyword

    queries = asked(spark, "crisis talk", "praise")
    found = lambda: sorted((r.folder, r.qid, r.field, r.Id, round(r.score, 9)) for r in bm25(queries, store.index).collect())
    plan = bm25(queries, store.index)._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [crisis,praise,talk])" in plan
    few = found()
    monkeypatch.setattr(keyword, "LITERAL_TERMS", 2)
    assert "In(term" not in bm25(queries, store.index)._jdf.queryExecution().executedPlan().toString()
    assert found() == few and few


def test_buckets_of_postings_hold_few_mails(spark, tmp_path):
    mails = spark.range(0, 20_001, 1, 4).select(
        F.lit("inbox").alias("folder"), F.col("id").alias("Id"), F.lit("a").alias("ExtractedSubject"),
        F.lit("b").alias("ExtractedBodyText"), F.lit(None).cast("string").alias("ExtractedFrom"), F.lit(None).cast("timestamp_ntz").alias("date_sent"),
    )
    write_index(mails, str(tmp_path))
    found = load_index(spark, str(tmp_path)).postings
    sizes = found.filter("field = 'body'").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in sizes) == 20_001 and max(r["count"] for r in sizes) <= 2_500


def test_terms_without_postings_do_not_shuffle_them(spark, store):
    parsed = parse_queries(asked(spark, "talk from Alice"))
    unknown = spark.range(3_000).select(F.lit("Alice").alias("Name"), F.concat(F.lit("x"), "id").alias("Alias"))
    known = spark.createDataFrame([("Alice", "alice@corp.com")], "Name string, Alias string")
    few = sender_terms(parsed, known)
    want = match_best_field(parsed, store.index, sender_terms=few, text_col="relevant_text").collect()
    spark.conf.set("spark.mailweave.broadcastBytes", "100000")
    try:
        hits = match_best_field(parsed, store.index, sender_terms=sender_terms(parsed, known.unionByName(unknown)), text_col="relevant_text")
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(folder" not in plan and sorted(hits.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.mailweave.broadcastBytes")


def test_field_statistics_shuffle_no_terms(spark):
    """They come from the heads, one row per text, and not from the dictionary."""
    rows = [
        ("inbox", "body", "a", 1, 2, 3, True), ("inbox", "body", "b", 1, 1, 3, False), ("inbox", "body", "a", 2, 1, 1, True),
        ("inbox", "subject", "a", 2, 1, 1, True), ("sent", "body", "c", 3, 5, 5, True), ("sent", "body", "c", 3, 5, 5, True),
        (None, "body", "d", 4, 1, 2, True), (None, "body", "e", 4, 1, 2, False),
    ]
    held = spark.createDataFrame(rows, "folder string, field string, term string, Id bigint, tf int, len int, head boolean")
    terms, fields = corpus_stats(held)
    assert sorted(map(tuple, fields.collect()), key=str) == sorted(
        [("inbox", "body", 2, 2.0), ("inbox", "subject", 1, 1.0), ("sent", "body", 2, 5.0), (None, "body", 1, 2.0)], key=str
    )
    assert {tuple(r) for r in terms.collect()} == {
        ("inbox", "body", "a", 2), ("inbox", "body", "b", 1), ("inbox", "subject", "a", 1), ("sent", "body", "c", 2),
        (None, "body", "d", 1), (None, "body", "e", 1),
    }
    assert fields._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1


def test_postings_are_written_from_sorted_runs(spark, tmp_path):
    """The same rows as counted in place, those of many mails in one run in the order of the files."""
    from mailweave.sources.postings import FIELDS, _postings, _postings_in_runs

    rows = [
        ("sent", 1, "b a B", "x  b\ny", "Éa@c.org", None), ("inbox", 2, None, "", "o'neil", "2024-01-02 03:04:05"),
        ("inbox", 2, None, "b b é z", None, "2024-01-02 03:04:05"), (None, 3, "𝒳 ￮ 1", None, "a", None),
        ("inbox", None, "a", "a", "a", None), ("sent", 4, "", "...", None, None), ("sent", 1, "b a B", "x  b\ny", "Éa@c.org", None),
    ]
    names = ["ExtractedSubject", "ExtractedBodyText", "ExtractedFrom"]
    mails = spark.createDataFrame(rows, f"folder string, Id bigint, {' string, '.join(names)} string, date_sent string")
    mails = mails.withColumn("date_sent", F.col("date_sent").cast("timestamp_ntz")).coalesce(1)
    count = lambda found: sorted(map(tuple, found.collect()), key=str)
    want = _postings(mails, FIELDS, "Id")
    one = _postings_in_runs(mails, FIELDS, "Id")
    assert one.columns == want.columns and [f.dataType for f in one.schema] == [f.dataType for f in want.schema]
    assert count(one) == count(want) and len(count(want)) > 20
    keys = [(r.folder or "", r.field, r.term.encode()) for r in one.collect()]
    assert keys == sorted(keys)
    assert count(_postings_in_runs(mails, FIELDS, "Id", 3, 2)) == count(want)
    assert count(_postings_in_runs(mails.withColumn("Id", F.col("Id").cast("string")), FIELDS, "Id", 5)) == count(
        _postings(mails.withColumn("Id", F.col("Id").cast("string")), FIELDS, "Id")
    )
    assert _postings_in_runs(mails.filter("Id < 0"), FIELDS, "Id").count() == 0
    write_index(mails, str(tmp_path))
    assert count(load_index(spark, str(tmp_path)).postings) == count(want.drop("head"))


def test_words_of_many_mails_are_hashed_once(spark):
    """The built-in encoder of whole tables: vectors of the expression, without a hash per word."""
    from mailweave.functions.text import tokens
    from mailweave.functions.vectors import hash_encode
    from mailweave.operators import encode

    texts = ["b a B", None, "", "é o'neil 𝒳 ￮", "...", "a " * 3000, "b a B", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "Id int, text string").coalesce(1)
    rows = lambda found: sorted(map(tuple, found.collect()))
    for dim in (64, 7, 1):
        want = rows(df.select("Id", hash_encode(F.col("text"), dim).alias("embedding")))
        assert rows(encode.embed(df, "text", dim=dim)) == want
        words = df.select("Id", tokens(F.col("text")).alias("_words"))
        assert rows(words.mapInArrow(encode._hashed(["Id"], dim, 16, 4), "Id int, embedding array<float>")) == want
    plan = encode.embed(df, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "MapInArrow" in plan


def test_shuffles_of_a_stored_table_are_dropped(spark):
    from mailweave import session

    def held():
        return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()

    df = spark.range(1000).repartition(3, "id")
    before = held()
    kept = session.stored(df, "spread")
    assert held() <= before and kept.count() == 1000
    assert spark.conf.get(session.CLEANUP_CONF, "false") == "false"
    # The same rows can still be computed again.
    assert session.stored(df, "spread").count() == df.count() == 1000
    spark.conf.set(session.CLEANUP_CONF, "true")
    session.stored(df, "spread")
    assert spark.conf.get(session.CLEANUP_CONF) == "true"
    spark.conf.unset(session.CLEANUP_CONF)
