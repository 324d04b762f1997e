"""Near duplicates of texts and vectors against brute force."""

import random
import re

import numpy as np
import pytest

from mailweave.llm import components as component_links
from mailweave.llm import ngram_join, vector_join
from mailweave.llm.components import components


def groups(nodes, pairs):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


def shingle_set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    sets = [(d, shingle_set(t)) for d, t in rows if d is not None]
    pairs = [
        (a, b) for k, (a, s) in enumerate(sets) for b, t in sets[:k]
        if s and t and 100 * len(s & t) >= 75 * len(s | t)
    ]
    return groups({d for d, _ in sets}, pairs)


def near_copies(seed=3):
    """Large groups of near copies around the threshold, with a passage that all share."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    shared = rnd.choices(vocabulary, k=30)
    rows = []
    for group in range(6):
        base = rnd.choices(vocabulary, k=rnd.choice([20, 60, 120])) + shared
        for _ in range(60):
            words = list(base)
            for _ in range(rnd.randrange(5)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                words = words[rnd.randrange(6) :]
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("long_list, chunk", [(48, 4096), (4, 16), (10_000, 4096)])
def test_ngram_join(spark, monkeypatch, long_list, chunk):
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    monkeypatch.setattr(ngram_join, "BLOCK", 2000)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df).collect()}
    assert found == brute(rows)


def test_ngram_join_of_pair_between_short_and_long_lists(spark):
    """The first shingle in common is in a short list, the others in long lists where only one of
    the two texts has them in its shortest prefix."""
    passage, single, body = range(1000, 1025), [1], range(100, 174)
    apart, other, template = range(2000, 2100), range(3000, 3300), []
    for k in range(60):
        template.append([*body, *other, 10_000 + k])
    for k in range(20):
        template.append([*other, 20_000 + k])
    for k in range(39):
        template.append([*passage, *single, *apart, 30_000 + k])
    texts = [*template, [*passage, *single, *body], [*single, *body]]
    rows = [(k // 40, k, len(g), [v << 32 | v for v in sorted(g)]) for k, g in enumerate(texts)]
    sets = spark.createDataFrame(rows, "block bigint, doc_id bigint, n bigint, grams array<bigint>")
    lists = ngram_join.postings(sets, 8)
    first = {r.gram >> 32: r["count"] for r in lists.filter("first").groupBy("gram").count().collect()}
    assert first[1] <= ngram_join.LONG_LIST < min(first[k] for k in body)
    found = {r.node: r.component for r in components(ngram_join.links(lists, sets)).collect()}
    pairs = [
        (i, j) for i, g in enumerate(texts) for j, h in enumerate(texts[:i])
        if 100 * len({*g} & {*h}) >= 75 * len({*g, *h})
    ]
    want = groups(range(len(texts)), pairs)
    assert {k: found.get(k, k) for k in want} == want and want[len(texts) - 1] == len(texts) - 2


def test_ngram_join_of_odd_rows(odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    out = ngram_join.near_duplicates(odd).collect()
    assert len(out) == len(rows)
    want = brute(rows)
    for r in out:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
    assert sorted(r.n_shingles for r in out) == sorted(len(shingle_set(t)) for _, t in rows)
    assert ngram_join.near_duplicates(none).count() == 0
    # The stage judges rows: a text is not lost because its id stands on another one, too.
    kept = ngram_join.stage(odd.sparkSession, odd, "")
    own = [(k, t) for k, (i, t) in enumerate(rows) if i is not None]
    group = brute(own)
    least = {}
    for k, _ in own:
        least[group[k]] = min(rows[k][0], least.get(group[k], rows[k][0]))
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(least.values())
    assert kept.filter("doc_id IS NULL").count() == len(rows) - len(own)


def test_ngram_join_of_the_given_table(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()} == brute(rows)


def test_stage_keeps_what_is_no_copy(spark):
    """One id on three texts of which two are near copies, ids once, no id, and extra columns."""
    words = lambda seed, n=80: " ".join(f"w{seed}x{k}" for k in range(n))
    rows = [
        (7, words(1), "a", 1), (7, words(2), "b", 2), (7, words(2) + " more", "c", 3), (3, words(1) + " end", "d", 4), (9, words(4), "e", 5),
        (None, words(1), "f", 6), (9, words(4), "e", 5), (11, "", "g", 7), (12, None, "h", 8), (11, "", "i", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _row int").repartition(4)
    kept = ngram_join.stage(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.source) for r in kept.collect()), key=str)
    assert [f for f in found if f[1] not in "bc"] == sorted(
        [(3, "d"), (9, "e"), (None, "f"), (11, "g"), (12, "h"), (11, "i")], key=str
    )
    assert len([f for f in found if f[1] in "bc"]) == 1
    again = sorted(((r.doc_id, r.source) for r in ngram_join.stage(spark, docs.repartition(2), "").collect()), key=str)
    assert again == found
    once = docs.filter("source IN ('a', 'd', 'e', 'f')").dropDuplicates(["doc_id"])
    assert {r.source for r in ngram_join.stage(spark, once, "").collect()} == {"d", "e", "f"}


def test_long_near_copies_in_chunks_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LONG_LIST", 3)
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", 3000)
    monkeypatch.setattr(ngram_join, "BUCKET_BYTES", 1 << 10)
    rnd = random.Random(3)
    base = [f"w{k}" for k in range(1500)]
    texts = []
    for k in range(24):
        own = list(base)
        for _ in range(rnd.choice([3, 20, 45, 60, 90])):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(10**6)}"
        texts.append(" ".join(own))
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")).collect()}
    grams = [{*map(int, ngram_join.shingles(t))} for t in texts]
    pairs = [(a, b) for a in range(24) for b in range(a) if 100 * len(grams[a] & grams[b]) >= 75 * len(grams[a] | grams[b])]
    assert pairs and found == groups(set(range(24)), pairs)


def test_components(spark):
    rnd = random.Random(1)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(rnd.randrange(90), rnd.randrange(90)) for _ in range(60)] + [(200, 300 + k) for k in range(80)]
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    pairs = [p for p in pairs if p[0] != p[1]]
    assert found == groups({n for p in pairs for n in p}, pairs)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("most", [1, 7, 60, 1000])
def test_components_of_links_in_several_tasks(spark, monkeypatch, most):
    monkeypatch.setattr(component_links, "LINKS_PER_TASK", most)
    rnd = random.Random(4)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(rnd.randrange(90), rnd.randrange(90)) for _ in range(60)] + [(200, 300 + k) for k in range(80)]
    pairs += pairs[:30] + [(b, a) for a, b in pairs[20:50]]
    links = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(3)
    pairs = [p for p in pairs if p[0] != p[1]]
    found = components(links).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.component for r in found} == groups({n for p in pairs for n in p}, pairs)


def test_components_of_few_links_take_few_tasks(spark, monkeypatch):
    """However many partitions a shuffle has, a few links are settled without one."""
    links = spark.createDataFrame([(k, k + 1) for k in range(50)], "a bigint, b bigint")
    spark.sparkContext.setJobGroup("few links", "components")
    try:
        assert {r.component for r in components(links).collect()} == {0}
        status = spark.sparkContext.statusTracker()
        stages = {s for j in status.getJobIdsForGroup("few links") for s in status.getJobInfo(j).stageIds}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(stages) <= 6


def vectors(seed=2):
    rng = np.random.default_rng(seed)
    out = []
    for d, n in ((64, 300), (20, 80), (3, 40)):
        base = rng.normal(size=(n // 10, d))
        for k in range(n):
            v = base[k % len(base)] + rng.normal(size=d) * rng.choice([0.05, 0.3, 0.5, 2.0])
            out.append([float(np.float32(x)) for x in v])
    out += [out[0], out[0], [2 * x for x in out[1]], None, [], [0.0] * 64, [float("nan")] * 64, [None] + [1.0] * 63, [float("inf")] + [0.0] * 63]
    return [(k, v) for k, v in enumerate(out)] + [(5, out[5]), (None, out[0])]


def brute_vectors(rows):
    fine = [(k, np.array(v, dtype=float)) for k, v in rows if k is not None and v and None not in v]
    fine = [(k, v / np.linalg.norm(v)) for k, v in fine if np.isfinite(v).all() and np.abs(v).max() > 0]
    links, pairs = {}, []
    for a, (k, v) in enumerate(fine):
        n = 0
        for b, (m, w) in enumerate(fine):
            if a != b and len(v) == len(w) and v @ w >= 0.9:
                n += 1
                pairs.append((k, m))
        links[k] = n
    return links, groups({k for k, _ in rows if k is not None}, pairs)


@pytest.mark.parametrize("cell, chunk", [(4096, 65_536), (20, 65_536), (20, 30), (4096, 30)])
def test_vector_join(spark, monkeypatch, cell, chunk):
    monkeypatch.setattr(vector_join, "CELL", cell)
    monkeypatch.setattr(vector_join, "CHUNK", chunk)
    monkeypatch.setattr(vector_join, "SAMPLE_PER_CELL", 4)
    rows = vectors()
    links, least = brute_vectors(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    out = vector_join.near_vectors(df).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.n_links == (0 if r.vec_id is None else links.get(r.vec_id, 0))
        assert r.component_id == (None if r.vec_id is None else least[r.vec_id])


def test_vector_join_of_an_empty_table(spark):
    assert vector_join.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_vector_join_in_shuffled_form(spark, tiny_broadcast):
    rows = vectors(5)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    links, components_of = brute_vectors(rows)
    found = {(r.vec_id, r.n_links, r.component_id) for r in vector_join.near_vectors(df).collect() if r.vec_id is not None}
    assert {(k, n) for k, n, _ in found} == {*links.items()} | {(k, 0) for k, _ in rows if k is not None and k not in links}
    assert all(c == components_of[k] for k, _, c in found)


def near_blocks(n, d=64):
    """Vectors with partners at every cosine from 0.85 to 1."""
    rng = np.random.default_rng(n)
    base = rng.normal(size=(n // 4, d))
    out = [b / np.linalg.norm(b) for b in base]
    while len(out) < n:
        v = out[rng.integers(len(base))]
        w = rng.normal(size=d)
        w -= (w @ v) * v
        c = rng.uniform(0.85, 1)
        out.append(c * v + np.sqrt(1 - c * c) * w / np.linalg.norm(w))
    return np.array(out)


def test_cells_and_doubt_lose_no_pair(monkeypatch):
    """All blocks and cells together find each pair once: sure links, and doubtful ones near the limit."""
    monkeypatch.setattr(vector_join, "LEAF", 16)
    units = near_blocks(3000)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows = np.empty(len(units), vector_join.record(64))
    rows["node"], rows["size"], rows["q"] = np.arange(len(units)), 1, vector_join.in_steps(units)
    x = rows["q"].astype(np.float64) / vector_join.STEPS
    share = vector_join.budgets(64, 0.9) / vector_join.STEPS**2
    cos = units @ units.T
    sure, maybe, met = np.zeros(len(units), int), [], 0
    for block, s in enumerate(vector_join.block_starts(64)):
        tree = vector_join.grow(x[:, s : s + 8], 5)
        at, cell, lives = vector_join.visit(tree, x[:, s : s + 8], share[block])
        assert sorted(at[lives]) == list(range(len(units)))
        for c in np.unique(cell):
            homes, others = at[(cell == c) & lives], at[(cell == c) & ~lives]
            met += len(homes) * (len(homes) // 2 + len(others))
            if len(homes):
                kind, a, b = vector_join.compare(rows[homes], rows[others], block, 0.9)
                np.add.at(sure, a[kind == vector_join.SUM], b[kind == vector_join.SUM])
                maybe += list(zip(a[kind == vector_join.MAYBE], b[kind == vector_join.MAYBE]))
                assert (cos[a[kind == vector_join.LINK], b[kind == vector_join.LINK]] >= 0.9).all()
    pairs = {tuple(sorted(p)) for p in maybe}
    assert len(pairs) == len(maybe) and all(abs(cos[p] - 0.9) < 3e-3 for p in pairs)
    for a, b in pairs:
        if cos[a, b] >= 0.9:
            sure[a] += 1
            sure[b] += 1
    np.fill_diagonal(cos, 0)
    assert (sure == (cos >= 0.9).sum(axis=1)).all() and sure.sum() > 1000
    assert met < 0.75 * 8 * len(units) ** 2 / 2


def test_visits_leave_in_small_batches(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    units = rng.normal(size=(3000, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    x = vector_join.in_steps(units).astype(np.float64) / vector_join.STEPS
    trees = {64: [vector_join.grow(x[:, s : s + 8], 4) for s in vector_join.block_starts(64)]}
    columns = [pa.array(np.arange(3000)), pa.array(np.ones(3000, np.int64)), pa.array([u.tobytes() for u in units], pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, names=["node", "size", "unit"])
    assert vector_join.cells(trees[64][0]) == 16

    def sent(parts):
        met, most = set(), 0
        for out in vector_join.visits(iter([batch]), trees, parts, 0.9):
            most = max(most, out.nbytes)
            for r in out.to_pylist():
                for node in np.frombuffer(r["records"], vector_join.record(64))["node"].tolist():
                    met.add((r["block"], r["cell"], r["i"], r["j"], r["home"], node))
        return met, most

    split = {(64, 0, c): (2, 1) for c in range(16, 32)}
    whole, most = sent(split)
    assert most > 1 << 20
    monkeypatch.setattr(vector_join, "SENT_BYTES", 1 << 17)
    monkeypatch.setattr(vector_join, "REACH", 1 << 12)
    parted, most = sent(split)
    assert parted == whole and most < 1 << 18
    counts = [sum(r[c] for out in vector_join.visits(iter([batch]), trees, None, 0.9) for r in out.to_pylist()) for c in ("homes", "visitors")]
    assert counts[0] == 8 * 3000 and counts[1] == len({m for m in whole if not m[4] and m[0] > 0}) + len({(m[0], m[1], m[5]) for m in whole if not m[4] and m[0] == 0 and m[3] == 2})


def test_local_cuts_compare_fewer_pairs(monkeypatch):
    """Inside a cell the boxes leave out most comparisons, and no pair within reach."""
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(4000, 8)) / 8).astype(np.float32)
    first, rest = np.arange(3000), np.arange(3000, 4000)
    u, v = map(np.concatenate, zip(*vector_join.close_pairs(x, first, rest, 0.025)))
    far = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2, dtype=np.float64)
    want = {(i, j) for i, j in zip(*np.nonzero(far <= 0.025)) if i < j and i < 3000}
    assert want <= {(min(p), max(p)) for p in zip(u.tolist(), v.tolist())} and len(u) < 1.1 * len(want)
    u, v = map(np.concatenate, zip(*vector_join.close_pairs(x, first, rest, 0.025, inside=False)))
    assert {(int(a), int(b)) for a, b in zip(u, v)} >= {p for p in want if p[1] >= 3000} and (v >= 3000).all()


def test_components_within_a_task():
    rng = np.random.default_rng(6)
    u, v = rng.integers(0, 500, 300), rng.integers(0, 500, 300)
    found = vector_join.Groups(500)
    found.join(u[:100], v[:100])
    found.join(u[100:], v[100:])
    want = groups(set(range(500)), [*zip(u.tolist(), v.tolist())])
    assert [want[k] for k in range(500)] == found.label.tolist()
    assert groups(set(range(500)), [*zip(found.a, found.b)]) == want
    assert len(found.a) == 500 - len(set(want.values()))
