"""Rules, mixing and shards."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailweave.llm import mix, quality_rules, shards
from mailweave.llm.common import words

GAP = re.compile(r"[\x20\x09-\x0D]+")


def word_list(text):
    return [w for w in GAP.split(text or "") if w]


def test_rules_against_brute_force(odd):
    for r in quality_rules.rule_ledger(odd, keep=["doc_id", "text"]).collect():
        w = word_list(r.text)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        often = {g for g, n in collections.Counter(windows).items() if n > 1}
        marked = {i + k for i, g in enumerate(windows) if g in often for k in range(5)}
        lines = [x for x in (r.text or "").split("\n") if word_list(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(marked))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_symbols == sum((r.text or "").count(c) for c in "#*$%&|<>")
        assert bool(r.fail_bits & 1) == (len(w) < 10)
        assert bool(r.fail_bits & 2) == (100 * len(marked) > 20 * len(w))


def test_policies_and_ablation_read_only_bits(odd):
    ledger = quality_rules.rule_ledger(odd).cache()
    bits = [r.fail_bits for r in ledger.collect()]
    for version, chosen in quality_rules.POLICIES.items():
        m = quality_rules.mask(chosen)
        kept = [b & m == 0 for b in bits]
        assert [r.kept for r in quality_rules.apply_policy(ledger, version).collect()] == kept
        for r in quality_rules.ablation(ledger, version).collect():
            own = quality_rules.mask([r.rule])
            assert r.n_failed == sum(b & own != 0 for b in bits)
            assert r.n_kept_without == sum(b & (m & ~own) == 0 for b in bits)


def test_rules_of_an_empty_table(none):
    assert quality_rules.apply_policy(quality_rules.rule_ledger(none)).count() == 0
    assert {r.n_failed for r in quality_rules.ablation(quality_rules.rule_ledger(none)).collect()} == {0}


def brute_targets(sizes, weights=(5.0, 2.0, 1.0)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(sizes), dict.fromkeys(sizes, 0.0)
    while free:
        total = sum(w[s] for s in free)
        share = {s: left * w[s] / total for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def mixed(df):
    sized = df.withColumn("size", F.size(words(F.col("text"))).cast("bigint"))
    return mix.systematic_mix(sized)


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_mix_meets_the_targets(request, name):
    df = request.getfixturevalue(name)
    found = [r.asDict() for r in mixed(df).collect()]
    assert len(found) == df.count() and {*df.columns} < {*found[0]}
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert 0 <= r["copies"] <= 2
    want = brute_targets(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]


def test_mix_agrees_with_itself_and_emits_copies(docs):
    once = {(r.doc_id, r.copies) for r in mixed(docs).collect()}
    again = {(r.doc_id, r.copies) for r in mixed(docs.repartition(7)).collect()}
    assert once == again
    out = mix.emit_copies(mixed(docs))
    assert out.count() == sum(c for _, c in once) and out.columns == [*docs.columns, "size"]


def test_mix_keeps_columns_of_any_name(odd):
    """Columns named as those the operator adds or works with."""
    names = ["target", "source_size", "copies", "_copy", "_s", "_n", "_size", "_place", "_w", "_most", "_full", "_level"]
    wide = odd.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    sized = wide.withColumn("size", F.size(words(F.col("text"))).cast("bigint"))
    out = mix.systematic_mix(sized)
    assert out.columns == [*sized.columns, "_source_size", "_target", "_copies"]
    plain_ones = {(r.doc_id, r.text): r.copies for r in mixed(odd).collect()}
    found = out.collect()
    assert {(r.doc_id, r.text): r._copies for r in found} == plain_ones
    assert all(tuple(r[n] for n in names) == tuple(range(len(names))) for r in found)
    emitted = mix.emit_copies(out)
    assert emitted.columns == sized.columns and emitted.count() == sum(r._copies for r in found)


def test_mix_of_repeated_ids_agrees_with_itself(spark):
    rows = [(k % 5, "abc"[k % 3], "word " * (100 + k % 7), k) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string, k int")
    once = sorted((r.k, r.copies) for r in mixed(df).collect())
    assert once == sorted((r.k, r.copies) for r in mixed(df.repartition(5).sort("k")).collect())


def test_mix_of_an_empty_table(none):
    assert mixed(none).count() == 0


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_shards_are_exact_and_whole(request, name):
    df = request.getfixturevalue(name)
    found = shards.uniform_shards(df, 7).select("doc_id", "text", "shard", "slot").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in found], key=key) == sorted(map(tuple, df.select("doc_id", "text").collect()), key=key)
    by = collections.defaultdict(list)
    for r in found:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(by) == 7


def test_shards_of_an_empty_table_and_of_unstable_rows(none, docs):
    assert shards.uniform_shards(none, 7).count() == 0
    assert shards.uniform_shards(docs.repartition(5), 7, store_first=True).count() == docs.count()


def test_matrix_has_its_margins_and_spread():
    rng = np.random.default_rng(3)
    rows, cols = np.array([10, 0, 30, 60]), np.array([34, 33, 33])
    drawn = np.array([shards.deal(rng, rows, cols) for _ in range(2000)])
    assert (drawn.sum(axis=2) == rows).all() and (drawn.sum(axis=1) == cols).all()
    assert np.abs(drawn.mean(axis=0) - np.outer(rows, cols) / 100).max() < 0.2


def test_large_draws_follow_the_law():
    rng = np.random.default_rng(5)
    good, bad, n = 3 * 10**9, 7 * 10**9, 10**6
    x = np.array([shards.hypergeometric(rng, good, bad, n) for _ in range(2000)])
    assert abs(x.mean() - 0.3 * n) < 50 and 0.9 < x.std() / np.sqrt(n * 0.21) < 1.1


def test_crc_is_that_of_zlib(spark, odd):
    for r in odd.select("text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c")).collect():
        assert r.c == zlib.crc32((r.text or "").encode())
