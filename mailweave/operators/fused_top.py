"""Exact leading rows of fused rankings, without ranking every mail.

The fused score of a mail is the sum of 1 / (k + 1 + rank) over the variants of a query. Only the
edges of each variant's ranking are read: its best and its last ``depth`` mails. They, and the best
keyword hits, are the candidates. A counting pass then finds the true rank of every candidate in
every variant: the sorted scores of the candidates are shipped, and each task counts how many other
mails stand before each of them. So the scores of the candidates are exact.

A mail that is no candidate stands behind place ``depth`` in all variants, so its fused score, and
with the keyword score at that depth its blended score, is bounded. Where the n-th best candidate is
above that bound, the result is complete; the other queries go another round, four times as deep.
The least fused score, which scaling needs, is settled in the same way from the other edge. In each
of V variants the first n mails have 1 / (k + n) at least, so n mails do, while one behind depth
V (k + n) - k has less: a purely semantic search needs no second round but for the least score.

Rows written are bounded by queries, variants and depth, not by the mails. Queries are handled in
blocks whose vectors and candidates fit the broadcast limit. When the depth comes near the size of
the folders, all mails are ranked, which is cheaper then and gives the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from mailweave.operators.dense import PAIRS_PER_BATCH, _matrix, dense_rank_all
from mailweave.operators.fusion import (
    KEYS,
    RRF_K,
    blend,
    blended,
    bounds_of,
    combine,
    filled_value,
    rrf,
)
from mailweave.operators.joins import ROW_BYTES, attach, broadcast_limit
from mailweave.operators.ranking import by_score, tie_key, top_n
from mailweave.session import stored

FULL_SHARE = 6  # all mails are ranked when this many times the depth reaches the largest folder
DEEPER = 4
MANY_TASKS = 512  # beyond, the parts of a list are put together in two steps
PACKED = "folder string, qid bigint, place int, part int, ids binary, scores binary"
COUNTS = "folder string, qid bigint, place int, counts binary"


def _edge(ids: np.ndarray, scores: np.ndarray, depth: int, sign: int) -> np.ndarray:
    """Positions of the ``depth`` first (sign 1) or last (-1) of a list: score down, then id up."""
    keyed = sign * tie_key(scores)
    rows = np.arange(len(keyed))
    if len(keyed) > depth:
        floor = np.partition(keyed, len(keyed) - depth)[len(keyed) - depth]
        rows = np.flatnonzero(keyed >= floor)
    return rows[np.lexsort((sign * ids[rows], -keyed[rows]))][:depth]


class Variants:
    """The vectors of a block of queries, as a task uses them."""

    def __init__(self, table: pa.Table) -> None:
        self.qid = table.column("qid").to_numpy()
        self.variant = table.column("variant_no").to_numpy()
        self.matrix = _matrix(table.column("embedding"))

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """``(folder, ids, scores[mail, list])`` in pieces of bounded size."""
        step = max(1, PAIRS_PER_BATCH // max(1, len(self.qid)))
        for batch in batches:
            folders = batch.column("folder").to_pandas().to_numpy()
            ids = batch.column("Id").to_numpy()
            vectors = _matrix(batch.column("embedding"))
            for folder in np.unique(folders):
                rows = np.flatnonzero(folders == folder)
                for start in range(0, len(rows), step):
                    part = rows[start : start + step]
                    yield folder, ids[part], vectors[part] @ self.matrix.T


def _packed(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    columns = [pa.array([row[k] for row in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def edge_lists(variants: Variants, vectors: DataFrame, depth: int) -> DataFrame:
    """``(folder, qid, place, part, ids, scores)``: the first and last ``depth`` mails of each list,
    packed by task; ``place`` is that of the variant in ``variants``."""
    shared = vectors.sparkSession.sparkContext.broadcast(variants)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        kept: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        bounds: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for folder, ids, scores in v.scored(batches):
            keyed = tie_key(scores)
            least, most = bounds.setdefault(folder, (np.full(len(v.qid), -np.inf), np.full(len(v.qid), np.inf)))
            able = (keyed >= least) | (keyed <= most)
            for q in np.flatnonzero(able.any(axis=0)):
                new = able[:, q]
                old = kept.get((folder, q))
                all_ids, all_scores = ids[new], scores[new, q]
                if old is not None:
                    all_ids, all_scores = np.concatenate([old[0], all_ids]), np.concatenate([old[1], all_scores])
                if len(all_ids) > 2 * depth:
                    first, last = (_edge(all_ids, all_scores, depth, sign) for sign in (1, -1))
                    least[q], most[q] = tie_key(all_scores[first[-1]]), tie_key(all_scores[last[-1]])
                    ends = np.concatenate([first, last])
                    all_ids, all_scores = all_ids[ends], all_scores[ends]
                kept[folder, q] = all_ids, all_scores
        part = TaskContext.get().partitionId()
        rows = [
            (folder, int(v.qid[q]), int(q), part, ids.astype("<i8").tobytes(), scores.astype("<f8").tobytes())
            for (folder, q), (ids, scores) in kept.items()
        ]
        if rows:
            yield _packed(PACKED, rows)

    return vectors.mapInArrow(read, PACKED)


def _merge(rows: Iterator[tuple[int, bytes, bytes]], depth: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The ends of each list from its parts; mails of different parts differ."""
    lists: dict[int, list] = {}
    for place, ids, scores in rows:
        lists.setdefault(place, []).append((np.frombuffer(ids, "<i8"), np.frombuffer(scores, "<f8")))
    out = {}
    for place, parts in lists.items():
        ids, scores = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        ends = np.unique(np.concatenate([_edge(ids, scores, depth, sign) for sign in (1, -1)]))
        out[place] = ids[ends], scores[ends]
    return out


def edge_mails(edges: DataFrame, depth: int, tasks: int) -> DataFrame:
    """``(folder, qid, Id)``: mails at an end of any list of a query. A group holds the parts of the
    lists of one query in one folder: tasks times variants times ``depth``, bounded by two steps."""

    def parts_of(table: pa.Table) -> Iterator[tuple]:
        return zip(*[table.column(c).to_pylist() for c in ("place", "ids", "scores")])

    if tasks > MANY_TASKS:

        def closer(key: tuple, table: pa.Table) -> pa.Table:
            merged = _merge(parts_of(table), depth)
            folder, qid, part = (k.as_py() for k in key)
            rows = [(folder, qid, place, part, i.tobytes(), s.tobytes()) for place, (i, s) in merged.items()]
            return pa.Table.from_batches([_packed(PACKED, rows)])

        coarse = edges.withColumn("part", (F.col("part") % math.ceil(math.sqrt(tasks))).cast("int"))
        edges = coarse.groupBy(*KEYS, "part").applyInArrow(closer, PACKED)

    def mails(key: tuple, table: pa.Table) -> pa.Table:
        ids = np.unique(np.concatenate([i for i, _ in _merge(parts_of(table), depth).values()]))
        folder, qid = (k.as_py() for k in key)
        return pa.table({"folder": pa.array([folder] * len(ids), pa.string()), "qid": np.full(len(ids), qid), "Id": ids})

    return edges.groupBy(*KEYS).applyInArrow(mails, "folder string, qid bigint, Id bigint")


def _places(keys: np.ndarray, ids: np.ndarray, new_keys: np.ndarray, new_ids: np.ndarray) -> np.ndarray:
    """For each new mail, how many of the sorted candidates (``keys`` down, ``ids`` up) precede it."""
    left = np.searchsorted(-keys, -new_keys, side="left")
    right = np.searchsorted(-keys, -new_keys, side="right")
    tied = np.flatnonzero(left < right)
    if len(tied):
        # Equal scores stand in the order of the ids.
        held = np.isin(keys, new_keys[tied])
        flag = np.concatenate([np.zeros(held.sum(), int), np.ones(len(tied), int)])
        both_keys, both_ids = np.concatenate([keys[held], new_keys[tied]]), np.concatenate([ids[held], new_ids[tied]])
        order = np.lexsort((flag, both_ids, -both_keys))
        met = np.cumsum(1 - flag[order])
        position = np.empty(len(order), int)
        position[order] = met
        # Candidates met among the tied ones, plus those of other scores before them.
        others = left[tied] - np.searchsorted(-keys[held], -new_keys[tied], side="left")
        left[tied] = others + position[held.sum() :]
    return left


class Candidates:
    """The candidates of a block of queries: their ids, and their order in every list."""

    def __init__(self, table: pa.Table, variants: Variants) -> None:
        place = {(int(q), int(v)): k for k, (q, v) in enumerate(zip(variants.qid, variants.variant))}
        names, folders = np.unique(table.column("folder").to_pandas().to_numpy().astype(str), return_inverse=True)
        qid, variant = table.column("qid").to_numpy(), table.column("variant_no").to_numpy()
        ids, keyed = table.column("Id").to_numpy(), tie_key(table.column("score").to_numpy())
        self.lists: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
        self.ids: dict[str, dict[int, np.ndarray]] = {}
        order = np.lexsort((ids, -keyed, variant, qid, folders))
        folders, qid, variant, ids, keyed = folders[order], qid[order], variant[order], ids[order], keyed[order]
        cut = np.flatnonzero(
            np.concatenate([[True], (folders[1:] != folders[:-1]) | (qid[1:] != qid[:-1]) | (variant[1:] != variant[:-1])])
        ) if len(ids) else np.empty(0, int)
        for start, end in zip(cut, [*cut[1:], len(ids)]):
            folder, q = str(names[folders[start]]), int(qid[start])
            at = place[q, int(variant[start])]
            self.lists.setdefault(folder, {})[at] = keyed[start:end], ids[start:end]
            self.ids.setdefault(folder, {})[q] = np.sort(ids[start:end])


def counted_before(variants: Variants, candidates: Candidates, vectors: DataFrame) -> DataFrame:
    """``(folder, qid, place, counts)``: by task, how many other mails, which are no candidates of
    the query, come right before each candidate of a list, and after the last."""
    shared = vectors.sparkSession.sparkContext.broadcast((variants, candidates))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, c = shared.value
        met: dict[tuple, np.ndarray] = {}
        for folder, ids, scores in v.scored(batches):
            keyed = tie_key(scores)
            others: dict[int, np.ndarray] = {}
            for at, (keys, own) in c.lists.get(folder, {}).items():
                q = int(v.qid[at])
                if q not in others:
                    known = c.ids[folder][q]
                    slot = np.minimum(np.searchsorted(known, ids), len(known) - 1)
                    others[q] = np.flatnonzero(known[slot] != ids)
                new = others[q]
                counts = np.bincount(_places(keys, own, keyed[new, at], ids[new]), minlength=len(keys) + 1)
                met[folder, at] = met[folder, at] + counts if (folder, at) in met else counts
        rows = [(folder, int(v.qid[at]), at, counts.astype("<i8").tobytes()) for (folder, at), counts in met.items()]
        if rows:
            yield _packed(COUNTS, rows)

    return vectors.mapInArrow(count, COUNTS)


def candidate_scores(embedded: DataFrame, wanted: DataFrame, vectors: DataFrame, rows: int | None = None) -> DataFrame:
    """``(folder, qid, variant_no, Id, score)`` of ``wanted(folder, qid, Id)`` in every variant;
    ``rows`` is a known bound on ``wanted``."""
    size = None if rows is None else rows * ROW_BYTES
    found = attach(vectors.select("folder", "Id", "embedding"), wanted, ["folder", "Id"], ["Id"], "inner", size)
    sides = embedded.select("qid", "variant_no", F.col("embedding").alias("query_vector"))
    # The vectors of a block of queries fit the broadcast limit.
    found = attach(found, sides, ["qid"], ["Id"], "inner", None if rows is None else 0)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = np.einsum("ij,ij->i", _matrix(batch.column("embedding")), _matrix(batch.column("query_vector")))
                kept = batch.select(["folder", "qid", "variant_no", "Id"])
                yield kept.append_column("score", pa.array(score))

    return found.mapInArrow(multiply, "folder string, qid bigint, variant_no int, Id bigint, score double")


def fused_scores(
    variants: Variants, embedded: DataFrame, wanted: DataFrame, vectors: DataFrame, k: int = RRF_K, rows: int | None = None
) -> DataFrame:
    """``(folder, qid, Id, score)``: the exact fused scores of ``wanted(folder, qid, Id)``. The
    candidates of a block of queries pass through the driver."""
    held = Candidates(candidate_scores(embedded, wanted, vectors, rows).toArrow(), variants)
    shared = vectors.sparkSession.sparkContext.broadcast(held)

    def fuse(key: tuple, table: pa.Table) -> pa.Table:
        folder, qid = (x.as_py() for x in key)
        lists, ids = shared.value.lists[folder], shared.value.ids[folder][qid]
        before: dict[int, np.ndarray] = {}
        for place, counts in zip(table.column("place").to_pylist(), table.column("counts").to_pylist()):
            counts = np.frombuffer(counts, "<i8")
            before[place] = before[place] + counts if place in before else counts
        score = np.zeros(len(ids))
        for place in sorted(before):
            own = lists[place][1]
            rank = np.cumsum(before[place])[:-1] + np.arange(len(own))
            score[np.searchsorted(ids, own)] += 1.0 / (rank + (k + 1))
        return pa.table({"folder": pa.array([folder] * len(ids), pa.string()), "qid": np.full(len(ids), qid), "Id": ids, "score": score})

    counted = counted_before(variants, held, vectors)
    return counted.groupBy(*KEYS).applyInArrow(fuse, "folder string, qid bigint, Id bigint, score double")


def _blocks(embedded: DataFrame, facts: Row, depth: int) -> list[DataFrame]:
    """The queries in parts whose vectors and candidates fit the broadcast limit."""
    size = facts["lists"] * (8 * facts["dim"] + 2 * 24 * depth * (2 * facts["most"] + 1))
    limit = broadcast_limit(embedded)
    parts = math.ceil(size / limit) if limit else min(3, facts["queries"])
    if parts <= 1:
        return [embedded]
    return [embedded.filter(F.pmod(F.xxhash64("qid"), F.lit(parts)) == i) for i in range(parts)]


def fused_top(
    embedded: DataFrame,
    vectors: DataFrame,
    keyword: DataFrame | None,
    queries: DataFrame,
    corpus: DataFrame,
    n: int,
    hits_only: bool = False,
    k: int = RRF_K,
) -> DataFrame:
    """What ``combine`` gives for the ``n`` first mails of every query, from the fused rankings of
    ``embedded(qid, variant_no, embedding)`` and the scores ``keyword(folder, qid, Id, score)``."""
    embedded = stored(
        embedded.select(F.col("qid").cast("bigint"), F.col("variant_no").cast("int"), "embedding").filter(F.col("embedding").isNotNull()),
        "variants",
    )
    vectors = vectors.select("folder", F.col("Id").cast("bigint"), "embedding").filter(F.col("embedding").isNotNull())
    keyword = None if keyword is None else stored(keyword.select(*KEYS, "Id", F.col("score").alias("kw")), "keyword_scores")
    sizes = {r["folder"]: r["count"] for r in vectors.groupBy("folder").count().collect()}
    per_query = embedded.groupBy("qid").agg(F.count(F.lit(1)).alias("v"), F.max(F.size("embedding")).alias("dim"))
    facts = per_query.agg(
        F.sum("v").alias("lists"), F.max("v").alias("most"), F.max("dim").alias("dim"), F.count(F.lit(1)).alias("queries")
    ).first()
    asked = queries.select("qid", "query")
    if not facts["lists"] or not sizes:
        return _all_ranked(embedded, vectors, keyword, asked, corpus, n, hits_only, k)
    depth = facts["most"] * (k + n) - k
    left, done = None, []
    while FULL_SHARE * depth < max(sizes.values()):
        mine = embedded if left is None else embedded.join(left, "qid", "left_semi")
        rounds = []
        for block in _blocks(mine, facts, depth):
            variants = Variants(block.toArrow())
            if not len(variants.qid):
                continue
            own = asked.join(block.select("qid").distinct(), "qid", "left_semi")
            hits = None if keyword is None else _of(keyword, own)
            rounds.append(_round(variants, block, per_query.select("qid", "v"), vectors, sizes, hits, own, corpus, n, depth, hits_only, k))
        results, closed = (_union([r[i] for r in rounds]) for i in (0, 1))
        done.append(attach(results, closed, ["qid"], ["Id"], "left_semi"))
        left = (asked.select("qid") if left is None else left).join(closed, "qid", "left_anti")
        left = stored(left, "left")
        depth *= DEEPER
        if left.join(per_query, "qid", "left_semi").first() is None:
            break  # the rest has no vectors
    if left is None or left.first() is not None:
        rest = asked if left is None else asked.join(left, "qid", "left_semi")
        done.append(_all_ranked(embedded.join(rest, "qid", "left_semi"), vectors, keyword, rest, corpus, n, hits_only, k))
    return _union(done)


def _all_ranked(
    embedded: DataFrame, vectors: DataFrame, keyword: DataFrame | None, queries: DataFrame, corpus: DataFrame, n: int, hits_only: bool, k: int
) -> DataFrame:
    ranked = rrf(dense_rank_all(embedded, vectors), k)
    hits = None if keyword is None else _of(keyword, queries).withColumnRenamed("kw", "score")
    return combine(ranked, hits, queries, corpus, n, hits_only)


def _of(rows: DataFrame, queries: DataFrame) -> DataFrame:
    return attach(rows, queries.select("qid"), ["qid"], ["Id"], "left_semi")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _round(
    variants: Variants, block: DataFrame, per_query: DataFrame, vectors: DataFrame, sizes: dict[str, int], keyword: DataFrame | None, queries: DataFrame,
    corpus: DataFrame, n: int, depth: int, hits_only: bool, k: int,
) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` mails of every query by the candidates of one depth, and the queries
    ``(qid)`` whose result is settled."""
    tasks = math.ceil(sum(sizes.values()) / 1000)  # no more tasks than this hold a list's parts in full
    wanted = edge_mails(edge_lists(variants, vectors, depth), depth, tasks)
    most_rows = len(variants.qid) * depth * 3 * len(sizes)
    hits = None
    if keyword is not None:
        hits = stored(top_n(keyword.withColumnRenamed("kw", "score"), KEYS, depth, by_score()), "hits")
        wanted = wanted.unionByName(hits.select(*KEYS, "Id"))
        wanted = wanted.distinct()
    wanted = stored(wanted, "candidates")
    fused = stored(fused_scores(variants, block, wanted, vectors, k, most_rows).withColumnRenamed("score", "sem"), "fused")
    merged = wanted.join(fused, [*KEYS, "Id"], "left")
    none = F.lit(None).cast("double")
    if keyword is None:
        merged, kw_bounds = merged.withColumn("kw", none), None
    else:
        # A candidate of the vectors may be a hit far down the keyword list.
        known = attach(keyword, wanted, [*KEYS, "Id"], ["Id"], "left_semi")
        merged = merged.join(known, [*KEYS, "Id"], "left")
        kw_bounds = keyword.groupBy(*KEYS).agg(*bounds_of("kw"))
    sem_bounds = fused.groupBy(*KEYS).agg(F.min("sem").alias("sem_low"), F.max("sem").alias("sem_high"))
    listed_mails = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    sem_bounds = sem_bounds.withColumn("sem_n", F.element_at(listed_mails, F.col("folder")))
    if kw_bounds is None:
        bounds = sem_bounds.withColumn("kw_low", none).withColumn("kw_high", none).withColumn("kw_n", F.lit(0).cast("bigint"))
    else:
        bounds = sem_bounds.join(kw_bounds, KEYS, "full").withColumns(
            {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("sem_n", "kw_n")}
        )
    merged = stored(merged.select(*KEYS, "Id", "sem", "kw"), "merged")
    scored, stats = blended(merged, bounds, queries, corpus, n, hits_only)
    result = stored(top_n(scored, KEYS, n, by_score()), "result")

    # What a mail that is no candidate can have at most.
    facts = attach(stats, per_query, ["qid"], ["folder"])
    nth = result.groupBy(*KEYS).agg(F.min(tie_key(F.col("score"))).alias("nth"), F.count(F.lit(1)).alias("rows"))
    facts = facts.join(nth, KEYS, "left")
    floor = F.lit(0.0)
    if hits is not None:
        deepest = hits.filter(F.col("rank") == depth - 1).select(*KEYS, F.col("score").alias("floor"))
        facts = facts.join(deepest, KEYS, "left")
        floor = F.coalesce("floor", F.lit(0.0))
    most = blend(filled_value("sem", F.col("v") / F.lit(float(k + 1 + depth))), filled_value("kw", floor))
    # The least fused score is settled, or an absent mail has less.
    least = F.col("v") / (k + F.greatest(F.col("sem_n") - depth, F.lit(0)))
    settled = (F.col("sem_n") < F.col("n_docs")) | (F.col("sem_low") <= least)
    listed = F.col("sem_n") <= depth
    enough = (F.col("rows") >= n) & (F.col("nth") > tie_key(most)) & settled
    # Folders without vectors have all their candidates in the keyword list.
    no_list = (F.col("sem_n") == 0) & (F.col("kw_n") <= depth)
    state = facts.groupBy("qid").agg(F.min(F.coalesce(listed & (F.col("kw_n") <= depth) | enough | no_list, F.lit(False))).alias("ok"))
    return result, stored(state.filter("ok").select("qid"), "settled")
