"""The audit against applying the filters one after the other."""

import collections
import itertools
import re

import numpy as np
import pytest

from mailweave.llm import filter_audit as fa

GAP = re.compile(r"[\x20\x09-\x0D]+")


def failing(docs):
    """The failed filters of every document, in plain Python."""
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    out = []
    for doc_id, text, _ in docs:
        t = text or ""
        w = [x for x in GAP.split(t) if x]
        checks = [
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            any(c in t for c in "#$%&*|"), doc_id is not None and doc_id > least[t],
        ]
        out.append({f for f, bad in zip("ABCDE", checks) if bad})
    return out


def applied(docs, labels):
    good, toxic = ({d for d, *marks in labels if d is not None and marks[k] == 1} for k in (0, 1))
    fails = failing(docs)
    rows, removed_by = {}, collections.Counter()
    for part in {lang or "" for _, _, lang in docs}:
        own = [(d, f) for (d, _, lang), f in zip(docs, fails) if (lang or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                failed = sum(name in f for _, f in own)
                rows[part, order, step] = [
                    len(left), len(gone), failed - len(gone), sum(f == {name} for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                ]
                removed_by[part, name] += len(gone)
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def check(docs, labels):
    rows = docs.select("doc_id", "text", "lang").collect()
    marks = labels.select("doc_id", "quality", "toxic").collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in fa.audit(fa.judge(docs, labels)).collect()}
    assert found == applied([tuple(r) for r in rows], [tuple(r) for r in marks])


def odd_labels(spark):
    rows = [(0, 1, 0), (1, 0, 1), (1, 1, 0), (2, None, None), (9, 1, 1), (None, 1, 1), (999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_odd_documents(spark, odd):
    check(odd, odd_labels(spark))


def test_shuffled_form(spark, odd, tiny_broadcast):
    check(odd, odd_labels(spark))


def test_given_documents(spark, docs):
    check(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))


def test_empty_table(spark, none):
    assert fa.audit(fa.judge(none, odd_labels(spark))).count() == 0


@pytest.mark.parametrize("filters", ["AB", "ABC"])
def test_contractions_of_other_numbers_of_filters(filters):
    rng = np.random.default_rng(len(filters))
    cells = rng.integers(0, 9, [1] + [2] * len(filters))
    found = fa.interactions(np.stack([cells, cells, cells]), filters)
    k = 0
    for order in fa.orders(filters):
        gone = np.zeros_like(cells[0], dtype=bool)
        for name in order:
            fails = np.moveaxis(np.zeros_like(gone), filters.index(name), 0)
            fails[1] = True
            fails = np.moveaxis(fails, 0, filters.index(name))
            assert found["removed"][0, k] == cells[0][fails & ~gone].sum()
            assert found["redundant"][0, k] == cells[0][fails & gone].sum()
            gone |= fails
            assert found["kept"][0, k] == cells[0][~gone].sum()
            k += 1


def test_removed_adds_up(spark, docs):
    """What all steps remove and what is kept last is the part, in every order."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = fa.audit(fa.judge(docs, labels)).toPandas()
    sizes = dict(docs.groupBy("lang").count().collect())
    for (part, _), rows in out.groupby(["part", "filter_order"]):
        assert rows["removed"].sum() + rows.loc[rows["step"] == 5, "kept"].iloc[0] == sizes[part or None]
