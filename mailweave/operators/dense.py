"""Exact inner-product ranking of many query vectors over many mail vectors."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.operators.joins import attach, broadcast_limit, measured_bytes
from mailweave.operators.ranking import by_score, rank_within, tie_key, top_n

SCORES = "folder string, qid bigint, variant_no int, Id bigint, score double"
SCORE_SCHEMA = pa.schema(
    [
        ("folder", pa.string()),
        ("qid", pa.int64()),
        ("variant_no", pa.int32()),
        ("Id", pa.int64()),
        ("score", pa.float64()),
    ]
)
RANKS = "folder string, qid bigint, Id bigint, ranks array<int>"
RANK_SCHEMA = pa.schema(
    [("folder", pa.string()), ("qid", pa.int64()), ("Id", pa.int64()), ("ranks", pa.list_(pa.int32()))]
)
PAIRS_PER_BATCH = 1 << 20
LARGE = 2.0**1000
TILE = 512  # queries and mails of one matrix product
BLOCK_ROWS = 2048
MOST_BLOCK_ROWS = 32 * BLOCK_ROWS
RANKS_PER_TASK = 1 << 27
RANKS_PER_QUERY = 1 << 24  # ranks of a query in one task


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type = np.float64) -> np.ndarray:
    """Rows of a list column as a matrix."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(array) == 0:
        return np.empty((0, 0), kind)
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(array), -1)


def _score_batch(
    folder: str, ids: np.ndarray, scores: np.ndarray, qid: np.ndarray, variant: np.ndarray
) -> pa.RecordBatch:
    """Score rows of one block: ``scores`` is mails by variants."""
    mails, variants = scores.shape
    return pa.RecordBatch.from_arrays(
        [
            pa.array([folder]).take(pa.array(np.zeros(mails * variants, dtype=np.int32))),
            pa.array(np.tile(qid, mails)),
            pa.array(np.tile(variant, mails)),
            pa.array(np.repeat(ids, variants)),
            pa.array(scores.ravel()),
        ],
        schema=SCORE_SCHEMA,
    )


def _folders(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Folder, ids and vectors of the mails of a batch, a folder at a time."""
    folders = batch.column("folder").to_pandas().to_numpy()
    ids = batch.column("Id").to_numpy()
    vectors = _matrix(batch.column("embedding"))
    for folder in np.unique(folders):
        rows = folders == folder
        yield folder, ids[rows], vectors[rows]


def _all_scores(
    batches: Iterable[pa.RecordBatch], qid: np.ndarray, variant: np.ndarray, queries: np.ndarray
) -> Iterator[pa.RecordBatch]:
    step = max(1, PAIRS_PER_BATCH // max(1, len(qid)))
    for folder, ids, vectors in (part for batch in batches for part in _folders(batch)):
        for start in range(0, len(ids), step):
            part = slice(start, start + step)
            yield _score_batch(folder, ids[part], vectors[part] @ queries.T, qid, variant)


def _query_scores(
    batches: Iterable[pa.RecordBatch], qid: np.ndarray, variant: np.ndarray, queries: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The greatest score of a mail over the variants of a query, which has number 0 then."""
    order = np.argsort(qid, kind="stable")
    names, place = np.unique(qid[order], return_inverse=True)
    queries = queries[order]
    step = max(1, PAIRS_PER_BATCH // max(TILE, len(names)))
    for folder, ids, vectors in (part for batch in batches for part in _folders(batch)):
        for start in range(0, len(ids), step):
            part = slice(start, start + step)
            best = np.full((len(names), len(ids[part])), -np.inf)
            for first in range(0, len(qid), TILE):
                scores = queries[first : first + TILE] @ vectors[part].T
                own = place[first : first + TILE]
                heads = np.concatenate([[0], np.nonzero(np.diff(own))[0] + 1])
                met = own[heads]
                best[met] = np.maximum(best[met], np.maximum.reduceat(scores, heads, axis=0))
            yield _score_batch(folder, ids[part], best.T, names, np.zeros(len(names), np.int32))


class Near:
    """Scores in single precision with a bound on their error, by which few rows need exact ones;
    in double precision where the numbers are too large. Arrays are used again."""

    def __init__(self, queries: np.ndarray) -> None:
        self.norms = _norms(queries)
        self.queries = {np.float64: queries}
        self.room: dict[tuple, np.ndarray] = {}
        self.kind = np.float64

    def scores(self, span: slice, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        longest = _norms(vectors).max(initial=0.0)
        self.kind = np.float32 if longest * self.norms.max(initial=0.0) < 1e30 and longest < 1e30 else np.float64
        if self.kind not in self.queries:
            self.queries[self.kind] = self.queries[np.float64].astype(self.kind)
        queries = self.queries[self.kind][span]
        out = self._room(self.kind, len(queries), len(vectors))
        np.matmul(queries, vectors.astype(self.kind).T, out=out)
        steps = 2.0 * (vectors.shape[1] + 4) * np.finfo(self.kind).eps
        return out, steps * longest * self.norms[span] + 1e-36

    def lowered(self, floor: np.ndarray) -> np.ndarray:
        """``floor`` in the precision of the scores, not above it."""
        kind = np.finfo(self.kind)
        return np.nextafter(np.clip(floor, kind.min, kind.max).astype(self.kind), self.kind(kind.min))

    def at_least(self, scores: np.ndarray, floor: np.ndarray) -> np.ndarray:
        return np.greater_equal(scores, self.lowered(floor)[:, None], out=self._room(bool, *scores.shape))

    def _room(self, kind: type, *shape: int) -> np.ndarray:
        if (kind, shape) not in self.room:
            self.room[kind, shape] = np.empty(shape, kind)
        return self.room[kind, shape]


def _norms(vectors: np.ndarray) -> np.ndarray:
    """Lengths; 0 for a vector without a finite one, whose scores lead nowhere."""
    largest = np.abs(vectors).max(axis=1, initial=0.0)
    return np.where(np.isfinite(largest), largest * np.sqrt(vectors.shape[1]), 0.0)


class _Leaders:
    """The best rows so far of every query, ``depth`` at most: score down, then id up."""

    def __init__(self, queries: int, depth: int) -> None:
        self.depth = depth
        self.floor = np.full(queries, -LARGE)  # no score below it can lead
        self.size = np.zeros(queries, dtype=np.int64)
        self.ids = np.zeros((queries, 0), dtype=np.int64)
        self.scores = np.zeros((queries, 0))

    def _widen(self, rows: int) -> None:
        if rows > self.ids.shape[1]:
            more = ((0, 0), (0, min(self.depth, 2 * rows) - self.ids.shape[1]))
            self.ids, self.scores = np.pad(self.ids, more), np.pad(self.scores, more)

    def held(self, queries: np.ndarray | slice) -> np.ndarray:
        """Which places of the rows of ``queries`` are taken."""
        return np.arange(self.ids.shape[1]) < self.size[queries, None]

    def meet(self, first: int, ids: np.ndarray, queries: np.ndarray, vectors: np.ndarray, near: "Near") -> None:
        """Take in the scores of ``queries``, from the query ``first`` on, with the mails ``ids``."""
        span = slice(first, first + len(queries))
        scores, error = near.scores(span, vectors)
        able = near.at_least(scores, self.floor[span] - error)
        if np.count_nonzero(able) > 4 * self.depth * len(scores) and len(ids) > self.depth:
            able &= np.isfinite(scores)
            low = np.where(able, scores, -np.inf)
            least = np.partition(low, len(ids) - self.depth, axis=1)[:, len(ids) - self.depth].astype(np.float64)
            able &= scores >= near.lowered(np.maximum(_below(least), -LARGE) - 2 * error)[:, None]
        q, mail = np.divmod(np.flatnonzero(able.ravel()), len(ids))
        exact = np.einsum("ij,ij->i", queries[q], vectors[mail])
        # Rows without a finite score lead nowhere.
        fine = np.isfinite(exact)
        q, mail, exact = q[fine], mail[fine], exact[fine]
        if not len(q):
            return
        met = np.unique(q)
        held = self.held(first + met)
        held_q = np.repeat(met, self.size[first + met])
        all_q = np.concatenate([held_q, q])
        all_ids = np.concatenate([self.ids[first + met][held], ids[mail]])
        all_scores = np.concatenate([self.scores[first + met][held], exact])
        keys = tie_key(all_scores)
        order = np.lexsort((all_ids, -keys, all_q))
        all_q, keys = all_q[order], keys[order]
        heads = np.searchsorted(all_q, met)
        counts = np.diff(np.append(heads, len(all_q)))
        place = np.arange(len(all_q)) - np.repeat(heads, counts)
        kept = place < self.depth
        self._widen(int(place[kept].max()) + 1)
        to = (first + all_q[kept], place[kept])
        self.ids[to] = all_ids[order][kept]
        self.scores[to] = all_scores[order][kept]
        self.size[first + met] = np.minimum(counts, self.depth)
        full = counts >= self.depth
        self.floor[first + met[full]] = _below(keys[heads[full] + self.depth - 1])


def _below(key: np.ndarray) -> np.ndarray:
    """No score with this ``tie_key`` or a greater one lies below."""
    return key - np.abs(key) * 2.0**-30


def _best_scores(
    batches: Iterable[pa.RecordBatch],
    qid: np.ndarray,
    variant: np.ndarray,
    queries: np.ndarray,
    depth: int,
) -> Iterator[pa.RecordBatch]:
    """Keep only the best rows per query while reading, so a task emits depth rows each."""
    kept: dict[str, _Leaders] = {}
    near = Near(queries)
    for folder, ids, vectors in (part for batch in batches for part in _folders(batch)):
        leaders = kept.setdefault(folder, _Leaders(len(qid), depth))
        for start in range(0, len(ids), TILE):
            part = vectors[start : start + TILE]
            for first in range(0, len(qid), TILE):
                leaders.meet(first, ids[start : start + TILE], queries[first : first + TILE], part, near)
    for folder, leaders in kept.items():
        step = max(1, PAIRS_PER_BATCH // depth)
        for first in range(0, len(qid), step):
            span = slice(first, first + step)
            held = leaders.held(span)
            rows = np.repeat(np.arange(len(held)), leaders.size[span])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([folder]).take(pa.array(np.zeros(len(rows), dtype=np.int32))),
                    pa.array(qid[span][rows]),
                    pa.array(variant[span][rows]),
                    pa.array(leaders.ids[span][held]),
                    pa.array(leaders.scores[span][held]),
                ],
                schema=SCORE_SCHEMA,
            )


def _sides(variants: DataFrame, vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    queries = variants.select(
        F.col("qid").cast("bigint"), F.col("variant_no").cast("int"), "embedding"
    ).filter(F.col("embedding").isNotNull())
    mails = vectors.select("folder", F.col("Id").cast("bigint"), "embedding").filter(
        F.col("embedding").isNotNull()
    )
    return queries, mails


def dense_scores(
    variants: DataFrame, vectors: DataFrame, depth: int | None = None, per_query: bool = False
) -> DataFrame:
    """Inner product of every query variant with every mail vector of a folder.

    ``variants(qid, variant_no, embedding)``, ``vectors(folder, Id, embedding)``. Mail
    vectors are read once and multiplied in Arrow batches with the query matrix, which is
    shipped to the tasks when measured small. More queries are handled in a grid of query
    blocks and mail blocks, where each task holds one block of either side. ``depth``
    keeps the best rows of a list within each task; None returns all scores. ``per_query`` keeps
    within each task the greatest score of a mail over the variants of a query: their maximum is
    that over all variants.
    """
    spark = vectors.sparkSession
    queries, mails = _sides(variants, vectors)
    depth = None if depth is None else max(depth, 1)
    size = measured_bytes(queries)
    if size > broadcast_limit(queries):
        return _grid_scores(queries, mails, depth, per_query)

    table = queries.toArrow()
    shared = spark.sparkContext.broadcast(
        (
            table.column("qid").to_numpy(),
            table.column("variant_no").to_numpy(),
            _matrix(table.column("embedding")),
        )
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if len(shared.value[0]) == 0:
            return iter(())
        return _scores(batches, *shared.value, depth, per_query)

    return mails.mapInArrow(score, SCORES)


def _scores(batches, qid, variant, queries, depth: int | None, per_query: bool) -> Iterator[pa.RecordBatch]:
    if per_query:
        return _query_scores(batches, qid, variant, queries)
    if depth is None:
        return _all_scores(batches, qid, variant, queries)
    return _best_scores(batches, qid, variant, queries, depth)


def _grid_scores(queries: DataFrame, mails: DataFrame, depth: int | None, per_query: bool = False) -> DataFrame:
    """Block grid: each query block meets each mail block in exactly one small group."""
    # A side is copied as often as the other has blocks: they are as large as their results allow.
    q_rows = m_rows = BLOCK_ROWS if depth is None else 8 * BLOCK_ROWS
    piece = F.xxhash64("qid", "variant_no")
    if per_query:
        # The variants of a query give one row for a mail where they are in one block, so a query is
        # in as few blocks as it needs, and blocks are the larger, the more variants a query has.
        sizes = queries.groupBy("qid").agg(F.count(F.lit(1)).alias("_n"))
        variants = sizes.agg(F.avg("_n")).first()[0] or 1.0
        q_rows = m_rows = min(MOST_BLOCK_ROWS, int(BLOCK_ROWS * math.sqrt(variants)))
        wide = sizes.filter(F.col("_n") > q_rows).select("qid", F.ceil(F.col("_n") / q_rows).alias("_parts"))
        queries = attach(queries, wide, ["qid"], ["variant_no"])
        piece = F.xxhash64("qid", F.pmod(F.xxhash64("variant_no"), F.coalesce("_parts", F.lit(1))))
    q_blocks = max(1, math.ceil(queries.count() / q_rows))
    found = mails.count()
    m_blocks = max(1, math.ceil(found / m_rows))
    if per_query:  # large blocks still keep all cores busy
        busy = math.ceil(2 * mails.sparkSession.sparkContext.defaultParallelism / q_blocks)
        m_blocks = max(m_blocks, min(busy, math.ceil(found / BLOCK_ROWS)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q_grid = queries.withColumn("_q", F.pmod(piece, F.lit(q_blocks)).cast("int")).withColumn("_m", every(m_blocks))
    q_grid = q_grid.select("qid", "variant_no", "embedding", "_q", "_m")
    m_grid = mails.withColumn(
        "_m", F.pmod(F.xxhash64("Id"), F.lit(m_blocks)).cast("int")
    ).withColumn("_q", every(q_blocks))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return SCORE_SCHEMA.empty_table()
        args = (
            right.combine_chunks().to_batches(),
            left.column("qid").to_numpy(),
            left.column("variant_no").to_numpy(),
            _matrix(left.column("embedding")),
        )
        return pa.Table.from_batches(list(_scores(*args, depth, per_query)), schema=SCORE_SCHEMA)

    return (
        q_grid.groupBy("_q", "_m").cogroup(m_grid.groupBy("_q", "_m")).applyInArrow(score, SCORES)
    )


def dense_rank_all(
    variants: DataFrame, vectors: DataFrame, depth: int | None = None, per_query: bool = False
) -> DataFrame:
    """``(folder, qid, variant_no, Id, score, rank)``, best first; all mails unless ``depth``.

    ``per_query`` asks for ``(folder, qid, Id, ranks)`` instead, where ``ranks`` holds the ranks of a
    mail in the lists of all variants of a query. Where the mail vectors are small, they are shipped
    to the tasks and nothing else is shuffled than the query vectors. Where the query vectors are, the
    scores of a query are shuffled in packed form and ranked in one task. Where neither is, the rows
    come as without ``per_query``.
    """
    keys = ["folder", "qid", "variant_no"]
    if per_query and depth is None:
        queries, mails = _sides(variants, vectors)
        for ways in (_ranks_per_query, _ranks_per_list):
            ranked = ways(queries, mails)
            if ranked is not None:
                return ranked
    scores = dense_scores(variants, vectors, depth)
    if depth is not None:
        return top_n(scores, keys, depth, by_score())
    mails = vectors.count()
    return rank_within(scores, keys, by_score(), group_rows=mails, rows=mails * variants.count())


def _ranks_per_query(queries: DataFrame, mails: DataFrame) -> DataFrame | None:
    """All ranks of a mail for a query, by a task that holds all mail vectors and the variants of a few
    queries at a time; None where the mails, or the lists of one query, are too many for that.

    The vectors are held in the precision they are given in, and multiplied in double precision.
    """
    single = mails.schema["embedding"].dataType.elementType == T.FloatType()
    width = F.size("embedding") * (4 if single else 8) + 32
    rows, size = mails.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    asked = queries.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    widest, lists = asked[0] or 0, asked[1] or 0
    if size > broadcast_limit(mails) or widest * rows > RANKS_PER_QUERY:
        return None
    table = mails.toArrow()
    folder, ids = table.column("folder").to_pandas().to_numpy(), table.column("Id").to_numpy()
    vectors = _matrix(table.column("embedding"), np.float32 if single else np.float64)
    parts = []
    for name in np.unique(folder):
        own = np.nonzero(folder == name)[0]
        own = own[np.argsort(ids[own], kind="stable")]
        parts.append((name, ids[own], vectors[own]))
    shared = mails.sparkSession.sparkContext.broadcast(parts)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches, schema=asked_schema)
        if not held.num_rows:
            return
        qid, variant = held.column("qid").to_numpy(), held.column("variant_no").to_numpy()
        order = np.lexsort((variant, qid))
        qid, variant, wanted = qid[order], variant[order], _matrix(held.column("embedding"))[order]
        # Whole queries, as many as their ranks allow.
        heads = np.concatenate([[0], np.nonzero(np.diff(qid))[0] + 1])
        ends = np.append(heads[1:], len(qid))
        start = 0
        for head, end, further in zip(heads, ends, [*ends[1:], None]):
            if further is None or (further - start) * rows > RANKS_PER_QUERY:
                span = slice(start, end)
                for part in shared.value:
                    yield from _rank_lists(part, qid[span], variant[span], wanted[span])
                start = end

    tasks = max(1, math.ceil(lists * rows / RANKS_PER_TASK), int(mails.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = queries.select("qid", "variant_no", F.col("embedding").cast("array<double>")).repartition(tasks, "qid")
    asked_schema = pa.schema([("qid", pa.int64()), ("variant_no", pa.int32()), ("embedding", pa.list_(pa.float64()))])
    return spread.mapInArrow(rank, RANKS)


def _ranks_per_list(queries: DataFrame, mails: DataFrame) -> DataFrame | None:
    """All ranks of a mail for a query, by a task that gets the scores of all mails of a folder with the
    variants of one query; None where the queries, or the lists of one query, are too many for that.

    The scores travel in packs of mails, without a row for each.
    """
    if measured_bytes(queries) > broadcast_limit(queries):
        return None
    most = mails.groupBy("folder").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    table = queries.filter("qid IS NOT NULL").toArrow()
    qid, variant = table.column("qid").to_numpy(), table.column("variant_no").to_numpy()
    order = np.lexsort((variant, qid))
    names, heads, counts = np.unique(qid[order], return_index=True, return_counts=True)
    if not most or not len(names) or counts.max() * most > RANKS_PER_QUERY or table.column("variant_no").null_count:
        return None
    step = max(1, 4 * PAIRS_PER_BATCH // len(qid))
    asked = {int(name): slice(head, head + n) for name, head, n in zip(names, heads, counts)}
    shared = mails.sparkSession.sparkContext.broadcast((asked, variant[order], _matrix(table.column("embedding"))[order]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, _, wanted = shared.value
        for folder, ids, vectors in (part for batch in batches for part in _folders(batch)):
            order = np.argsort(ids, kind="stable")
            for start in range(0, len(ids), step):
                place = order[start : start + step]
                packed, keys = _packed(np.diff(ids[place], prepend=0)), tie_key(wanted @ vectors[place].T)
                lists = [_packed(keys[span]) for span in asked.values()]
                columns = [[folder] * len(asked), list(asked), [packed] * len(asked), lists]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, PACKS.types)], schema=PACKS)

    def rank(key: tuple, packs: pa.Table) -> pa.Table:
        folder, qid = key[0].as_py(), key[1].as_py()
        span = shared.value[0][qid]
        own = [np.cumsum(_unpacked(x, np.int64)) for x in packs.column("ids").to_pylist()]
        lists = zip(packs.column("scores").to_pylist(), own)
        keys = np.concatenate([_unpacked(x, np.float64).reshape(-1, len(i)) for x, i in lists], axis=1)
        ids = np.concatenate(own)
        place = np.argsort(ids, kind="stable")
        variant = shared.value[1][span]
        ranks = _ranks_of(keys[:, place], np.full(len(variant), qid), variant)
        return pa.Table.from_batches(_rank_rows(folder, ids[place], np.full(len(variant), qid), ranks), schema=RANK_SCHEMA)

    return mails.mapInArrow(score, "folder string, qid bigint, ids binary, scores binary").groupBy("folder", "qid").applyInArrow(rank, RANKS)


PACKS = pa.schema([("folder", pa.string()), ("qid", pa.int64()), ("ids", pa.binary()), ("scores", pa.binary())])


def _packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers, the first bytes of all before the second ones, as like bytes compress."""
    return np.ascontiguousarray(numbers.reshape(-1).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(packed: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view(kind).reshape(-1)


def _rank_lists(
    part: tuple[str, np.ndarray, np.ndarray], qid: np.ndarray, variant: np.ndarray, queries: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Ranks of the mails of a folder, which come in order of their ids, in the lists of some queries,
    which come in order of query and variant.

    Rows that repeat a variant or a mail are rows of the same list. The queries of a mail come together,
    as its id, and the queries in their order, then take little room where they are written.
    """
    folder, ids, vectors = part
    keys = np.empty((len(queries), len(ids)))
    for at in range(0, len(ids), 8 * TILE):
        keys[:, at : at + 8 * TILE] = queries @ vectors[at : at + 8 * TILE].astype(np.float64, copy=False).T
    return _rank_rows(folder, ids, qid, _ranks_of(tie_key(keys), qid, variant))


def _ranks_of(keys: np.ndarray, qid: np.ndarray, variant: np.ndarray) -> np.ndarray:
    """Ranks, mails by queries, from the ``tie_key`` of the scores, queries by mails. Rows of ``keys`` with the
    same query and variant are one list."""
    heads = np.concatenate([[0], np.nonzero((np.diff(qid) != 0) | (np.diff(variant) != 0))[0] + 1, [len(qid)]])
    ranks = np.empty((keys.shape[1], len(qid)), dtype=np.int32)
    for start, end in zip(heads[:-1], heads[1:]):
        # By mail, then by repeated variant: a stable sort keeps equal scores in order of the ids.
        flat = keys[start:end].T.ravel()
        flat = np.where(np.isnan(flat), -np.inf, -flat)  # as Spark sorts them
        found = np.empty(len(flat), dtype=np.int32)
        found[np.argsort(flat, kind="stable")] = np.arange(len(flat), dtype=np.int32)
        ranks[:, start:end] = found.reshape(-1, end - start)
    return ranks


def _rank_rows(folder: str, ids: np.ndarray, qid: np.ndarray, ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each mail and query with its ranks; ids and queries come in order."""
    names, place, lists = np.unique(qid, return_inverse=True, return_counts=True)
    mails, first, copies = np.unique(ids, return_index=True, return_counts=True)
    step = max(1, PAIRS_PER_BATCH // len(names))
    for at in range(0, len(mails), step):
        own = slice(at, at + step)
        n = len(mails[own])
        values = ranks[first[own][0] : first[own][-1] + copies[own][-1]]
        if copies[own].max() > 1:
            # The rows of a mail together within each query.
            mail = np.repeat(np.arange(n), copies[own])
            flat = values.ravel()[np.lexsort((np.tile(place, len(mail)), np.repeat(mail, len(qid))))]
        else:
            flat = values.ravel()
        offsets = np.concatenate([[0], np.cumsum((copies[own][:, None] * lists[None, :]).ravel())]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([folder]).take(pa.array(np.zeros(n * len(names), dtype=np.int32))),
                pa.array(np.tile(names, n)),
                pa.array(np.repeat(mails[own], len(names))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            ],
            schema=RANK_SCHEMA,
        )
