import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailweave.operators import fusion, joins, ranking
from mailweave.operators.dense import dense_rank_all, dense_scores
from mailweave.operators.fusion import combine, min_max, rrf
from mailweave.operators.joins import attach, salted_join
from mailweave.operators.ranking import by_score, first_n, number_docs, rank_all, rank_within, tie_key, top_n


def scores(spark, rows):
    return spark.createDataFrame(rows, "folder string, qid bigint, Id bigint, score double")


def random_scores(n=300, hot=0.6, seed=1):
    rng = random.Random(seed)
    return [
        ("inbox" if rng.random() < hot else "sent", rng.randrange(3), i, rng.choice([0.1, 0.5, rng.random()]))
        for i in range(n)
    ]


def expected_ranks(rows):
    groups = {}
    for f, q, i, s in rows:
        groups.setdefault((f, q), []).append((-s, i))
    return {(f, q, i): r for (f, q), g in groups.items() for r, (_, i) in enumerate(sorted(g))}


def as_ranks(df):
    return {(r.folder, r.qid, r.Id): r["rank"] for r in df.collect()}


@pytest.mark.parametrize("group_rows", [10**6, None])
def test_rank_within_both_forms(spark, group_rows):
    rows = random_scores()
    ranked = rank_within(scores(spark, rows), ["folder", "qid"], by_score(), group_rows=group_rows)
    assert as_ranks(ranked) == expected_ranks(rows)


def test_ranges_follow_the_rows_of_all_groups(spark, tiny_broadcast, monkeypatch):
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 9)
    rows = random_scores()
    ranked = rank_all(scores(spark, rows), ["folder", "qid"])
    assert as_ranks(ranked) == expected_ranks(rows)


def test_few_keys_are_hot_at_any_size(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    monkeypatch.setattr(joins, "HOT_KEYS", 4)
    big = spark.range(400).select(F.col("id").alias("Id"), (F.col("id") % 7).alias("k"))
    joined = salted_join(big, big.select("k").distinct().withColumn("v", F.col("k")), ["k"], ["Id"])
    assert joined.count() == 400 and joined.filter("k != v").count() == 0


def test_rank_does_not_depend_on_partitions(spark):
    rows = random_scores(seed=2)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    ranked = rank_all(scores(spark, rows).repartition(5), ["folder", "qid"])
    result = as_ranks(ranked)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert result == expected_ranks(rows)


@pytest.mark.parametrize("n", [0, 1, 5, 1500])
def test_top_n_is_a_prefix(spark, n):
    rows = random_scores(seed=3)
    got = as_ranks(top_n(scores(spark, rows), ["folder", "qid"], n, by_score()))
    assert got == {k: r for k, r in expected_ranks(rows).items() if r < n}


def test_tie_goes_to_lower_id(spark):
    noisy = 0.1 + 0.2
    got = as_ranks(rank_all(scores(spark, [("inbox", 1, 9, noisy), ("inbox", 1, 4, 0.3)]), ["folder", "qid"]))
    assert got == {("inbox", 1, 4): 0, ("inbox", 1, 9): 1}
    assert tie_key(1 / (61 + 10**6)) != tie_key(1 / (62 + 10**6))


def test_number_docs(spark):
    df = spark.createDataFrame([("inbox", 7), ("inbox", 3), ("sent", 5)], "folder string, Id bigint")
    assert {(r.Id, r.doc_no) for r in number_docs(df).collect()} == {(3, 1), (7, 2), (5, 1)}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_with_a_hot_key(spark, how, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    big = spark.range(500).select(
        F.col("id").alias("Id"),
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 20).alias("k"),
    )
    side = spark.createDataFrame([(0, "a"), (1, "b"), (5, "c"), (5, "d"), (99, "e")], "k bigint, v string")
    plain = sorted(map(tuple, big.join(side, "k", how).collect()), key=str)
    assert sorted(map(tuple, salted_join(big, side, ["k"], ["Id"], how).collect()), key=str) == plain
    assert sorted(map(tuple, attach(big, side, ["k"], ["Id"], how).collect()), key=str) == plain


def vectors(spark, n=60, dim=8, seed=4):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, dim)).astype(np.float32)
    values[7] = values[3]
    rows = [("sent" if i % 4 == 0 else "inbox", i, [float(x) for x in v]) for i, v in enumerate(values)]
    mails = spark.createDataFrame(rows, "folder string, Id bigint, embedding array<float>")
    asked = [(i // 3, i % 3, [float(x) for x in v]) for i, v in enumerate(values[:9])]
    queries = spark.createDataFrame(asked, "qid bigint, variant_no int, embedding array<float>")
    return mails, queries, values


def expected_dense(values):
    out = {}
    for i in range(9):
        for folder in ("inbox", "sent"):
            ids = [j for j in range(len(values)) if (j % 4 == 0) == (folder == "sent")]
            products = {j: float(values[j].astype(float) @ values[i].astype(float)) for j in ids}
            order = sorted(ids, key=lambda j: (-tie_key(products[j]), j))
            for rank, j in enumerate(order):
                out[(folder, i // 3, i % 3, j)] = (rank, round(products[j], 9))
    return out


def as_dense(df):
    return {
        (r.folder, r.qid, r.variant_no, r.Id): (r["rank"], round(r.score, 9)) for r in df.collect()
    }


@pytest.mark.parametrize("depth", [None, 5])
def test_dense_ranking(spark, depth):
    mails, queries, values = vectors(spark)
    want = {k: v for k, v in expected_dense(values).items() if depth is None or v[0] < depth}
    assert as_dense(dense_rank_all(queries, mails, depth)) == want


@pytest.mark.parametrize("depth", [None, 5])
def test_dense_ranking_in_blocks(spark, tiny_broadcast, monkeypatch, depth):
    monkeypatch.setattr("mailweave.operators.dense.BLOCK_ROWS", 4)
    mails, queries, values = vectors(spark)
    want = {k: v for k, v in expected_dense(values).items() if depth is None or v[0] < depth}
    assert as_dense(dense_rank_all(queries, mails, depth)) == want


@pytest.mark.parametrize("large", [False, True])
def test_greatest_score_of_a_query(spark, request, monkeypatch, large):
    """One row per mail and query leaves a task, not one per variant."""
    monkeypatch.setattr("mailweave.operators.dense.TILE", 2)
    if large:
        request.getfixturevalue("tiny_broadcast")
    mails, queries, values = vectors(spark)
    want = {}
    for (folder, qid, _, j), (_, score) in expected_dense(values).items():
        want[(folder, qid, j)] = max(score, want.get((folder, qid, j), -9.0))
    rows = dense_scores(queries, mails, per_query=True)
    assert rows.count() == len(want)
    assert {(r.folder, r.qid, r.Id): round(r.score, 9) for r in rows.collect()} == want


@pytest.mark.parametrize("most", [1 << 16, 20])
def test_variants_of_a_query_meet_in_one_block(spark, tiny_broadcast, monkeypatch, most):
    """A mail then has one row for a query, unless the query needs several blocks."""
    from mailweave.operators import dense

    monkeypatch.setattr(dense, "BLOCK_ROWS", 8)
    monkeypatch.setattr(dense, "MOST_BLOCK_ROWS", most, raising=False)
    mails, _, values = vectors(spark)
    rng = np.random.default_rng(6)
    wanted = rng.normal(size=(120, 8)).astype(np.float32)
    asked = [(i % 3, i, [float(x) for x in v]) for i, v in enumerate(wanted)]
    queries = spark.createDataFrame(asked, "qid bigint, variant_no int, embedding array<float>")
    rows = dense_scores(queries, mails, per_query=True).collect()
    assert len(rows) == 3 * 60 if most > 1000 else 3 * 60 <= len(rows) <= 3 * 60 * 2
    best = {}
    for r in rows:
        best[(r.qid, r.Id)] = max(r.score, best.get((r.qid, r.Id), -99.0))
    products = wanted.astype(float) @ values.astype(float).T
    assert all(s == pytest.approx(products[q::3, j].max(), abs=1e-9) for (q, j), s in best.items()) and len(best) == 180


def test_ranks_of_a_query_need_no_shuffle_of_pairs(spark):
    """Also with repeated variants and mails, which are rows of the same list."""
    mails, queries, _ = vectors(spark)
    mails, queries = mails.unionByName(mails.filter("Id < 5")), queries.unionByName(queries.filter("qid = 1"))
    fused = rrf(dense_rank_all(queries, mails, per_query=True))
    plan = fused._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan
    as_scores = lambda df: {(r.folder, r.qid, r.Id): round(r.score, 12) for r in df.collect()}
    assert fused.count() == fused.select("folder", "qid", "Id").distinct().count()
    assert as_scores(fused) == as_scores(rrf(dense_rank_all(queries, mails)))


@pytest.mark.parametrize("most", [None, 130])
def test_fused_rows_of_a_mail_come_together(spark, monkeypatch, most):
    """Its id is then written once for many queries; vectors ship in the precision they are given in."""
    from mailweave.operators import dense

    mails, queries, _ = vectors(spark)
    if most:
        monkeypatch.setattr(dense, "RANKS_PER_QUERY", most + 60)  # a query of three variants at a time
    spark.conf.set("spark.mailweave.broadcastBytes", str(60 * (8 * 4 + 32)))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        fused = rrf(dense_rank_all(queries, mails, per_query=True))
        assert not fused._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")
        rows = fused.collect()
    finally:
        spark.conf.unset("spark.mailweave.broadcastBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    runs = 1 + sum((a.folder, a.Id) != (b.folder, b.Id) for a, b in zip(rows, rows[1:]))
    assert len(rows) == 180 and runs == (180 if most else 60)
    want = {(r.folder, r.qid, r.Id): round(r.score, 12) for r in rrf(dense_rank_all(queries, mails)).collect()}
    assert {(r.folder, r.qid, r.Id): round(r.score, 12) for r in rows} == want


def test_ranks_of_many_mails(spark, tiny_broadcast):
    mails, queries, _ = vectors(spark)
    ranked = dense_rank_all(queries, mails, per_query=True)
    assert "rank" in ranked.columns and ranked.count() == queries.count() * mails.count()


@pytest.mark.parametrize("pairs", [1 << 20, 30])
def test_scores_of_a_query_are_ranked_from_packs(spark, monkeypatch, pairs):
    """More mails than can be shipped: no row for each score. Also with repeated variants and mails."""
    monkeypatch.setattr("mailweave.operators.dense.PAIRS_PER_BATCH", pairs)
    mails, queries, _ = vectors(spark)
    mails, queries = mails.unionByName(mails.filter("Id < 5")), queries.unionByName(queries.filter("qid = 1"))
    spark.conf.set("spark.mailweave.broadcastBytes", "2500")
    try:
        ranked = dense_rank_all(queries, mails, per_query=True)
    finally:
        spark.conf.unset("spark.mailweave.broadcastBytes")
    assert "ranks" in ranked.columns
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Window" not in plan
    as_scores = lambda df: {(r.folder, r.qid, r.Id): round(r.score, 12) for r in df.collect()}
    fused = rrf(ranked)
    assert fused.count() == fused.select("folder", "qid", "Id").distinct().count()
    assert as_scores(fused) == as_scores(rrf(dense_rank_all(queries, mails)))


def test_numbers_packed_by_bytes():
    from mailweave.operators.dense import _packed, _unpacked

    for values in (np.array([3, -1, 1 << 60, 0]), np.array([[0.5, -2.0], [np.inf, 1e-300]])):
        assert (_unpacked(_packed(values), values.dtype.type) == values.ravel()).all()


def test_leaders_keep_ties_and_drop_what_is_not_finite(spark, monkeypatch):
    monkeypatch.setattr("mailweave.operators.dense.TILE", 3)
    rows = [("inbox", j, [float(x)]) for j, x in enumerate([1, 2, 2, 3, 3, 3, "nan", 1, 3, 2, "inf", 3])]
    mails = spark.createDataFrame(rows[::-1], "folder string, Id bigint, embedding array<float>").coalesce(1)
    queries = spark.createDataFrame([(0, 0, [1.0]), (1, 0, [-1.0])], "qid bigint, variant_no int, embedding array<float>")
    got = dense_rank_all(queries, mails, 5).orderBy("qid", "rank").collect()
    assert [r.Id for r in got if r.qid == 0] == [3, 4, 5, 8, 11]
    assert [r.Id for r in got if r.qid == 1] == [0, 7, 1, 2, 9]


def test_dense_without_queries(spark):
    mails, queries, _ = vectors(spark)
    assert dense_scores(queries.filter("qid < 0"), mails).count() == 0


def test_rrf(spark):
    rows = [("inbox", 1, 0, 1, 0), ("inbox", 1, 0, 2, 1), ("inbox", 1, 1, 2, 0), ("inbox", 1, 1, 1, 1)]
    df = spark.createDataFrame(rows, "folder string, qid bigint, variant_no int, Id bigint, rank bigint")
    assert {round(r.score, 12) for r in rrf(df).collect()} == {round(1 / 61 + 1 / 62, 12)}


def test_min_max(spark):
    rows = [("inbox", 1, i, s) for i, s in enumerate([3.0, 3.0, 3.0])] + [
        ("inbox", 2, i, s) for i, s in enumerate([1.0, 2.0, 3.0])
    ]
    got = {(r.qid, r.Id): r.norm for r in min_max(scores(spark, rows)).collect()}
    assert [got[(1, i)] for i in range(3)] == [0, 0, 0]
    assert [got[(2, i)] for i in range(3)] == [0, 0.5, 1]


def dense_fill(sem, kw, length, ids, n):
    """The combination as first written down: fill with 0, scale, blend, sort."""
    if not sem and not kw:
        return []

    def scaled(part):
        filled = [part.get(i, 0.0) for i in ids]
        low, high = min(filled), max(filled)
        return [0.0 if low == high else (x - low) / (high - low) for x in filled]

    grow = 1 / (1 + np.exp(-0.9 * (length - 4)))
    weight = min(0.75, 0.25 + 0.5 * (grow - 1 / (1 + np.exp(2.7))))
    w = weight if sem and kw else (1.0 if sem else 0.0)
    s, k = (scaled(sem) if sem else [0.0] * len(ids)), (scaled(kw) if kw else [0.0] * len(ids))
    rows = [(i, w * a + (1 - w) * b) for i, a, b in zip(ids, s, k)]
    return sorted(rows, key=lambda r: (-tie_key(r[1]), r[0]))[:n]


@pytest.mark.parametrize("n", [3, 30, None])
def test_combine_equals_dense_fill(spark, n):
    rng = random.Random(5)
    ids = list(range(1, 41))
    cases = {
        1: ({i: rng.random() for i in ids}, {i: 5 * rng.random() for i in ids[10:14]}),
        2: ({i: rng.uniform(-1, 1) for i in ids[::2]}, {i: rng.random() for i in ids[1:5]}),
        3: ({}, {i: rng.random() for i in ids[20:22]}),
        4: ({i: rng.uniform(-1, -0.5) for i in ids[5:9]}, {}),
        5: ({i: 0.7 for i in ids}, {i: 2.0 for i in ids}),
        6: ({}, {}),
    }
    queries = spark.createDataFrame([(q, "word " * q) for q in cases], "qid bigint, query string")
    corpus = spark.createDataFrame([("inbox", i) for i in ids], "folder string, Id bigint")
    part = lambda c: scores(spark, [("inbox", q, i, s) for q, v in cases.items() for i, s in v[c].items()])
    got = {}
    for r in combine(part(0), part(1), queries, corpus, n).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append((r.Id, round(r.score, 9)))
    for q, (sem, kw) in cases.items():
        want = [(i, round(s, 9)) for i, s in dense_fill(sem, kw, q, ids, n)]
        assert got.get(q, []) == want, q


@pytest.mark.parametrize("hits_only", [False, True])
@pytest.mark.parametrize("sides", ["both", "sem", "kw"])
def test_full_ranking_by_query_of_odd_rows(spark, monkeypatch, sides, hits_only):
    """Repeated and null ids, scores and keys; repeated and unknown queries; folders without a mail."""
    nan = float("nan")
    sem = scores(spark, [
        *[("inbox", 1, i, 0.1 * i - 0.3) for i in range(6)], ("inbox", 1, 2, 0.7), ("inbox", 1, None, 0.2), ("inbox", 1, 8, None),
        *[("inbox", 2, i, 0.5) for i in range(12)], ("inbox", 3, 1, nan), ("inbox", 3, 2, 1.0), ("sent", 4, 20, 2.0),
        ("gone", 1, 1, 1.0), ("gone", 1, 2, 0.5), ("inbox", 9, 1, 0.4), ("inbox", 9, 2, 0.6), (None, 1, 1, 1.0), ("inbox", None, 1, 1.0),
    ])
    kw = scores(spark, [
        ("inbox", 1, 2, 4.0), ("inbox", 1, 2, 5.0), ("inbox", 1, 4, 1.0), ("inbox", 1, 7, 2.0), ("inbox", 1, 7, 2.0), ("inbox", 1, None, 3.0),
        ("inbox", 2, 3, 1.0), ("sent", 5, 20, 1.5), ("sent", 5, 21, 2.5), ("inbox", 9, 2, 1.0), (None, 1, 1, 1.0),
    ])
    queries = [(1, "one"), (2, "two words"), (2, "two words and many more of them"), (3, "c"), (4, "d"), (5, "e"), (None, "f")]
    queries = spark.createDataFrame(queries, "qid bigint, query string")
    mails = [("inbox", i) for i in [*range(10), 9, 9, None]] + [("sent", i) for i in (20, 21, 22)] + [(None, 5)]
    corpus = spark.createDataFrame(mails, "folder string, Id bigint")
    sem, kw = None if sides == "kw" else sem, None if sides == "sem" else kw
    in_order = lambda df: sorted((tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in df.collect()))
    spark.conf.set("spark.mailweave.broadcastBytes", "0")
    want = in_order(combine(sem, kw, queries, corpus, None, hits_only))
    spark.conf.unset("spark.mailweave.broadcastBytes")
    # Scores are shuffled once: none is stored.
    monkeypatch.setattr(fusion, "stored", lambda *_: 1 / 0)
    found = combine(sem, kw, queries, corpus, None, hits_only)
    assert in_order(found) == want and found.columns == ["folder", "qid", "Id", "score", "rank"]


def test_combine_hits_only(spark):
    queries = spark.createDataFrame([(1, "a")], "qid bigint, query string")
    corpus = spark.createDataFrame([("inbox", i) for i in range(5)], "folder string, Id bigint")
    kw = scores(spark, [("inbox", 1, 3, 2.0)])
    assert [r.Id for r in combine(None, kw, queries, corpus, 3, hits_only=True).collect()] == [3]
    assert [r.Id for r in combine(None, kw, queries, corpus, 3).orderBy("rank").collect()] == [3, 0, 1]


def test_rows_of_groups_within_the_cap_are_not_ranked(spark, monkeypatch):
    df = scores(spark, [("inbox", q, i, float(i % 7)) for q in (1, None) for i in range(5)] + [("sent", 1, 1, 1.0)])
    ranked = []
    put = ranking.rank_within
    monkeypatch.setattr(ranking, "GROUP_LIMIT", 0)
    monkeypatch.setattr(ranking, "rank_within", lambda df, *args: ranked.append(df.count()) or put(df, *args))
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(first_n(df, ["folder", "qid"], 5, by_score()).collect()) == order(df.collect()) and ranked == []
    got = first_n(df, ["folder", "qid"], 3, by_score()).collect()
    want = [("inbox", q, i, float(i)) for q in (1, None) for i in (2, 3, 4)] + [("sent", 1, 1, 1.0)]
    assert order(got) == order(want) and ranked == [10]


def test_unscored_mails_are_found_without_shuffling_pairs(spark, monkeypatch):
    monkeypatch.setattr(fusion, "BITS", 2)
    ids = spark.createDataFrame([("inbox", 1), ("inbox", 2), ("inbox", 2), ("inbox", None), ("sent", 1)], "folder string, Id bigint")
    asked = [("inbox", q, 0.5 * q if q else 0.0) for q in (1, 2, 3, 5, None)] + [("sent", 1, 0.25)]
    stats = spark.createDataFrame(asked, "folder string, qid bigint, rest double")
    seen = [("inbox", 1, 1), ("inbox", 2, 1), ("inbox", 3, 1), ("inbox", 5, 2), ("inbox", 5, None), ("inbox", None, 2), ("sent", 1, 1)]
    hits = spark.createDataFrame(seen, "folder string, qid bigint, Id bigint")
    size = 100 * fusion.ROW_BYTES
    got = fusion._all_unscored(stats, ids, hits, size)
    order = lambda df: sorted(map(tuple, df.select("folder", "qid", "Id", "score").collect()), key=str)
    assert order(got) == order(fusion._rest(stats, ids, hits, size)) and got.count() > 10
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(folder" in plan and "qid" not in "".join(x for x in plan.split("\n") if "hashpartitioning(" in x)


def test_windows_are_as_many_as_all_rows_need(spark, monkeypatch):
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 9)
    monkeypatch.setattr(ranking, "_window_rows", lambda df: 300)
    rows = random_scores()
    ranked = rank_within(scores(spark, rows), ["folder", "qid"], by_score(), group_rows=300, rows=300)
    assert as_ranks(ranked) == expected_ranks(rows)
    assert ", 34), REPARTITION_BY_NUM" in ranked._jdf.queryExecution().executedPlan().toString()
