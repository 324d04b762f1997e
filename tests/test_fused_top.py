"""Leading rows of fused rankings against ranking every mail."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailweave.operators import fused_top as ft
from mailweave.operators.dense import dense_rank_all
from mailweave.operators.fusion import combine, rrf

SCORES = "folder string, qid bigint, Id bigint, score double"


def world(spark, seed, mails=700, dim=6, queries=12, partial=False):
    """Mails in two folders with copies, zero vectors and near copies; queries of 1 to 3 variants."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(mails, dim)).astype(np.float32)
    vectors[60:90] = vectors[0]
    vectors[100:130] = 0
    vectors[130:180] = vectors[:50] + rng.normal(size=(50, dim)).astype(np.float32) * 1e-3
    folder = ["sent" if k % 5 == 0 else "inbox" for k in range(mails)]
    ids = rng.permutation(3 * mails)[:mails]
    corpus = spark.createDataFrame([(folder[k], int(ids[k])) for k in range(mails)], "folder string, Id bigint")
    have = [k for k in range(mails) if not partial or k % 7]
    stored_vectors = spark.createDataFrame(
        [(folder[k], int(ids[k]), vectors[k].tolist()) for k in have], "folder string, Id bigint, embedding array<float>"
    ).repartition(5)
    embedded, asked = [], []
    for q in range(queries):
        asked.append((q, "word " * (1 + q)))
        base = rng.normal(size=dim)
        for v in range(1 + q % 3):
            other = base + rng.normal(size=dim) * (0.1 if q % 2 else 3)
            embedded.append((q, v, (other if q != 5 else 0 * other).astype(np.float32).tolist()))
    embedded = spark.createDataFrame(embedded, "qid bigint, variant_no int, embedding array<float>")
    hits = []
    for q in range(queries):
        for k in rng.choice(mails, size=int(rng.integers(0, mails // 2)) if q != 3 else 0, replace=False):
            hits.append((folder[k], q, int(ids[k]), float(rng.choice([0.5, 1.0, rng.gamma(2)]))))
    return corpus, stored_vectors, embedded, spark.createDataFrame(asked, "qid bigint, query string"), spark.createDataFrame(hits, SCORES)


def in_order(df):
    return [(r.folder, r.qid, r["rank"], r.Id, round(r.score, 9)) for r in df.orderBy("folder", "qid", "rank").collect()]


@pytest.mark.parametrize("share", [0, 2])
@pytest.mark.parametrize("mode, partial", [("semantic", False), ("semantic", True), ("hybrid", False), ("hybrid", True)])
def test_equal_to_the_full_ranking(spark, monkeypatch, mode, partial, share):
    monkeypatch.setattr(ft, "FULL_SHARE", share)
    corpus, vectors, embedded, queries, hits = world(spark, 3 + partial, partial=partial)
    keyword = hits if mode == "hybrid" else None
    want = combine(rrf(dense_rank_all(embedded, vectors)), keyword, queries, corpus, 4)
    got = ft.fused_top(embedded, vectors, keyword, queries, corpus, 4)
    assert in_order(got) == in_order(want)


def test_blocks_of_queries(spark, monkeypatch, tiny_broadcast):
    monkeypatch.setattr(ft, "FULL_SHARE", 0)
    corpus, vectors, embedded, queries, hits = world(spark, 9, mails=300, queries=7)
    want = combine(rrf(dense_rank_all(embedded, vectors)), hits, queries, corpus, 3)
    assert in_order(ft.fused_top(embedded, vectors, hits, queries, corpus, 3)) == in_order(want)


def test_queries_and_folders_without_vectors(spark, monkeypatch):
    monkeypatch.setattr(ft, "FULL_SHARE", 0)
    corpus, vectors, embedded, queries, hits = world(spark, 11, mails=200, queries=6)
    embedded, vectors = embedded.filter("qid <> 2"), vectors.filter("folder = 'inbox'")
    want = combine(rrf(dense_rank_all(embedded, vectors)), hits, queries, corpus, 3)
    assert in_order(ft.fused_top(embedded, vectors, hits, queries, corpus, 3)) == in_order(want)
    assert ft.fused_top(embedded.limit(0), vectors, None, queries, corpus, 3).count() == 0
    nothing = ft.fused_top(embedded, vectors.limit(0), hits.limit(0), queries, corpus, 3)
    assert nothing.count() == 0


def test_small_folders_and_empty_blocks(spark, monkeypatch, tiny_broadcast):
    """A folder as small as the depth less k, and one query in three blocks."""
    monkeypatch.setattr(ft, "FULL_SHARE", 0)
    corpus, vectors, embedded, queries, hits = world(spark, 4, mails=360, queries=3)
    depth = 3 * (ft.RRF_K + 4) - ft.RRF_K
    assert vectors.filter("folder = 'sent'").count() == depth - ft.RRF_K
    queries, embedded, hits = (df.filter("qid = 2") for df in (queries, embedded, hits))
    monkeypatch.setattr(ft, "_blocks", lambda mine, facts, depth: [mine.filter(f"qid % 3 = {k}") for k in range(3)])
    want = combine(rrf(dense_rank_all(embedded, vectors)), hits, queries, corpus, 4)
    assert in_order(ft.fused_top(embedded, vectors, hits, queries, corpus, 4)) == in_order(want)


@pytest.mark.parametrize("tasks", [5, 10_000])
def test_edges_are_bounded_and_exact(spark, tasks):
    corpus, vectors, embedded, queries, _ = world(spark, 5)
    variants = ft.Variants(embedded.toArrow())
    edges = ft.edge_lists(variants, vectors, 25)
    assert all(len(r.ids) <= 2 * 25 * 8 for r in edges.collect())
    assert edges.count() <= 5 * 2 * embedded.count()
    want = set()
    sizes = dict(vectors.groupBy("folder").count().collect())
    for r in dense_rank_all(embedded, vectors).collect():
        if r["rank"] < 25 or r["rank"] >= sizes[r.folder] - 25:
            want.add((r.folder, r.qid, r.Id))
    found = ft.edge_mails(edges, 25, tasks).collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_scores_of_candidates_are_exact(spark):
    corpus, vectors, embedded, queries, _ = world(spark, 6)
    wanted = corpus.crossJoin(queries.select("qid")).filter("pmod(Id, 4) = qid % 4")
    found = ft.fused_scores(ft.Variants(embedded.toArrow()), embedded, wanted, vectors)
    full = {(r.folder, r.qid, r.Id): r.score for r in rrf(dense_rank_all(embedded, vectors)).collect()}
    rows = found.collect()
    assert len(rows) == wanted.count()
    assert all(abs(r.score - full[r.folder, r.qid, r.Id]) < 1e-12 for r in rows)


def test_places_among_ties():
    rng = np.random.default_rng(0)
    for _ in range(50):
        keys, ids = rng.integers(0, 5, 20) / 4, 2 * rng.permutation(100)[:20]
        order = np.lexsort((ids, -keys))
        keys, ids = keys[order], ids[order]
        new_keys, new_ids = rng.integers(0, 6, 30) / 4, 2 * rng.permutation(100)[:30] - 51
        want = [sum((k > m) or (k == m and i < j) for k, i in zip(keys, ids)) for m, j in zip(new_keys, new_ids)]
        assert ft._places(keys, ids, new_keys, new_ids).tolist() == want


@pytest.mark.parametrize("n", [1, 3, 8])
def test_lowest_unscored_mails(spark, tiny_windows, n):
    """Scores of either sign: unscored mails stand in between, by id."""
    rng = np.random.default_rng(n)
    corpus = spark.createDataFrame([("inbox" if k % 3 else "sent", 5 * k) for k in range(60)], "folder string, Id bigint")
    rows = []
    for q in range(6):
        count = (0, 5, 30, 55, 60, 59)[q]
        for k in (range(count) if q % 2 else rng.permutation(60)[:count].tolist()):
            rows.append(("inbox" if k % 3 else "sent", q, 5 * k, float(rng.normal())))
    hits = spark.createDataFrame(rows, SCORES)
    queries = spark.createDataFrame([(q, "some words") for q in range(6)], "qid bigint, query string")
    full = combine(None, hits, queries, corpus, None).filter(F.col("rank") < n)
    got = combine(None, hits, queries, corpus, n)
    assert in_order(got) == in_order(full)
