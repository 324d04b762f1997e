"""Near duplicates among vectors: exact cosine join by subspaces.

Unit vectors with cosine c lie at squared distance 2 - 2c. After a fixed random rotation a vector
is split into blocks of eight dimensions, each with its share of the allowed squared distance: if
two vectors are within the whole budget, they are within the share in at least one block. So a
range join per block, in eight dimensions, finds every pair, and the union of what the blocks
find is verified.

The range join of a block cuts its space into cells of about ``CELL`` vectors by medians of a
bounded sample, always along the widest dimension; the number of cuts follows the number of
vectors. A vector lives in one cell and visits those cells of a higher number that its ball
reaches, so a pair meets in one cell. What travels is the rotated vector in 16-bit steps, all
visitors of a cell from one batch in one row. A task cuts on inside its cell: it halves those that
live there again and again and keeps, for each part, only the visitors within reach of its box,
until ``LEAF`` are left to be compared by one product. More than ``CHUNK`` vectors in a cell are
dealt to several tasks.

A pair that several blocks find counts in the first of them; this is decided in whole numbers, so
all tasks agree. The steps leave the cosine uncertain by about 1e-4: pairs surely above the limit
count at once, pairs surely below go, and the few between are joined with the whole vectors and
decided in double precision. Tasks return sums of links per vector and just enough links to
connect the groups, never all pairs. Exact copies are one class throughout, weighted by its size.

The work of the range joins depends on the data: 0.9 cosine leaves balls in eight dimensions that
reach a fair part of the neighbouring cells, so it grows faster than the input, but slower than
its square. The links inside a group of near copies are all counted, and so cost its square.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing. Vectors of different length do not link. Rows with the same id count as separate
vectors, and a group is named by the smallest id. A null id links with nothing. Extra columns are
not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import table
from mailweave.llm.components import components
from mailweave.operators.joins import attach
from mailweave.session import stored

COSINE = 0.9
BLOCK = 8
CELL = 4096
CHUNK = 65_536
LEAF = 256
SAMPLE_BYTES = 32 << 20  # of 64-bit vectors, over all lengths, that place the cuts
SAMPLE_PER_CELL = 16
PACK = 32_768  # vectors whose visits are packed together
REACH = 1 << 21  # vectors by cells of a block that are looked at together
SENT_BYTES = 16 << 20  # of a batch of visits
STEPS = 32_767  # of a component
FUZZ = 1e-5  # beyond the rounding of 32-bit products


def unit_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(vec_id, class, unit)``: 64-bit unit vectors as bytes; null for those that cannot link."""
    import hashlib

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, units = [], []
            for value in batch.column("v"):
                v = np.array(value.as_py() if value.is_valid else [], dtype=np.float64)  # null components: nan
                most = np.abs(v).max() if len(v) else 0.0
                if not np.isfinite(v).all() or most == 0:
                    classes.append(None)
                    units.append(None)
                    continue
                v = v / most
                v = v / np.sqrt(np.dot(v, v)) + 0.0
                units.append(v.tobytes())
                classes.append(hashlib.blake2b(units[-1], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(classes, pa.binary()), pa.array(units, pa.binary())],
                names=["vec_id", "class", "unit"],
            )

    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return rows.mapInArrow(scale, "vec_id bigint, class binary, unit binary")


@lru_cache(maxsize=32)
def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def block_starts(d: int) -> list[int]:
    return list(range(0, d, BLOCK))


def in_steps(units: np.ndarray) -> np.ndarray:
    """Rotated unit vectors in whole steps of 16 bits."""
    return np.rint((units @ rotation(units.shape[1])) * STEPS).astype("<i2")


def budgets(d: int, cosine: float) -> np.ndarray:
    """Squared distance in steps that each block allows: a component is off by half a step."""
    whole = (math.sqrt(2 - 2 * cosine) * STEPS + math.sqrt(d)) ** 2
    sizes = np.array([min(s + BLOCK, d) - s for s in block_starts(d)])
    return whole * sizes / d * (1 + 1e-9)


def doubt(d: int) -> float:
    """How far the cosine of vectors in steps may be from the true one."""
    off = math.sqrt(d) / (2 * STEPS)
    return off * (2 + off) + 1e-9


def record(d: int) -> np.dtype:
    return np.dtype([("node", "<i8"), ("size", "<i8"), ("q", "<i2", (d,))])


def grow(x: np.ndarray, cuts: int) -> tuple | None:
    """Cells by medians along the widest dimension: ``(dim, cut, low, high)``."""
    if cuts == 0 or len(x) < SAMPLE_PER_CELL:
        return None
    dim = int(np.argmax(x.std(axis=0)))
    cut = float(np.median(x[:, dim]))
    low = x[:, dim] <= cut
    if low.all():
        return None
    return dim, cut, grow(x[low], cuts - 1), grow(x[~low], cuts - 1)


def cells(tree: tuple | None) -> int:
    """Number of cells of a tree."""
    return 1 if tree is None else cells(tree[2]) + cells(tree[3])


def visit(tree: tuple | None, x: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, cells, and whether the row lives there: its own cell, and those of a higher number
    that its ball reaches. Distances to a cell are taken per dimension."""
    found: list[tuple[np.ndarray, int, np.ndarray]] = []

    def go(node, rows, off, spent, lives, cell):
        if not len(rows):
            return
        if node is None:
            found.append((rows, cell, lives))
            return
        dim, cut, low, high = node
        side = x[rows, dim] - cut
        for child, number, beyond in ((low, 2 * cell, side > 0), (high, 2 * cell + 1, side <= 0)):
            gap = np.where(beyond, np.maximum(off[:, dim], np.abs(side)), off[:, dim])
            now = spent - off[:, dim] ** 2 + gap**2
            near = now <= budget
            offs = off[near]
            offs[:, dim] = gap[near]
            go(child, rows[near], offs, now[near], lives[near] & ~beyond[near], number)

    n = len(x)
    go(tree, np.arange(n), np.zeros(x.shape), np.zeros(n), np.ones(n, bool), 1)
    rows, cells, lives = (
        np.concatenate([np.full(len(f[0]), f[1]) if k == 1 else f[k] for f in found] or [np.empty(0, np.int64)]) for k in range(3)
    )
    lives = lives.astype(bool)
    home = np.zeros(n, dtype=np.int64)
    home[rows[lives]] = cells[lives]
    keep = lives | (cells > home[rows])
    return rows[keep], cells[keep], lives[keep]


def close_pairs(
    x: np.ndarray, homes: np.ndarray, others: np.ndarray, budget: float, inside: bool = True
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ``homes`` with ``others``, and with each other if ``inside``, within ``budget``;
    a few beyond it may be among them."""
    square = (x * x).sum(axis=1, keepdims=True)
    one = np.ones_like(square)
    # One product gives squared distances: -2xy + |x|^2 + |y|^2.
    left = np.concatenate([-2 * x, square, one], axis=1)
    right = np.concatenate([x, one, square], axis=1)
    limit = np.float32(budget + FUZZ)
    stack = [(homes, others)]
    while stack:
        h, o = stack.pop()
        low, high = x[h].min(axis=0), x[h].max(axis=0)
        if len(o):
            y = x[o]
            gap = np.maximum(low - y, 0) + np.maximum(y - high, 0)
            o = o[np.einsum("ij,ij->i", gap, gap) <= limit]
        if len(h) > LEAF:
            dim = int(np.argmax(high - low))
            order = np.argpartition(x[h, dim], len(h) // 2)
            a, b = h[order[: len(h) // 2]], h[order[len(h) // 2 :]]
            stack.append((a, o))
            stack.append((b, np.concatenate([o, a]) if inside else o))
            continue
        one_side = left[h]
        if inside:
            near = np.flatnonzero(np.triu(one_side @ right[h].T <= limit, 1))
            yield h[near // len(h)], h[near % len(h)]
        for q in range(0, len(o), 4096):
            some = o[q : q + 4096]
            near = np.flatnonzero(one_side @ right[some].T <= limit)
            yield h[near // len(some)], some[near % len(some)]


class Groups:
    """Which of the rows of a task are connected, and the links that say so."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.a: list[int] = []
        self.b: list[int] = []

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        apart = self.label[u] != self.label[v]
        u, v = u[apart], v[apart]
        while len(u):
            # Each label takes on the smallest label it meets; one link shows for each.
            p, q = self.label[u], self.label[v]
            high, low = np.maximum(p, q), np.minimum(p, q)
            order = np.lexsort((low, high))
            first = order[np.unique(high[order], return_index=True)[1]]
            self.a += u[first].tolist()
            self.b += v[first].tolist()
            self.label[high[first]] = low[first]
            while True:
                further = self.label[self.label]
                if (further == self.label).all():
                    break
                self.label = further
            apart = self.label[u] != self.label[v]
            u, v = u[apart], v[apart]


SUM, LINK, MAYBE = 0, 1, 2


def compare(
    homes: np.ndarray, others: np.ndarray, block: int, cosine: float, inside: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(kind, a, b)``: sums of links (node, number), links, and pairs to be verified."""
    rows = np.concatenate([homes, others])
    q, node, size = rows["q"], rows["node"], rows["size"]
    d = q.shape[1]
    share, doubtful, starts = budgets(d, cosine), doubt(d), block_starts(d)
    near = q.astype(np.float32) / np.float32(STEPS)
    x = np.ascontiguousarray(near[:, starts[block] : starts[block] + BLOCK])
    total = np.zeros(len(rows), dtype=np.int64)
    groups, maybe = Groups(len(rows)), []

    def settle(u: np.ndarray, v: np.ndarray) -> None:
        for k in range(0, len(u), 32_768):
            a, b = u[k : k + 32_768], v[k : k + 32_768]
            able = np.einsum("ij,ij->i", near[a], near[b]) >= cosine - doubtful - FUZZ
            a, b = a[able], b[able]
            if not len(a):
                continue
            p, r = q[a].astype(np.float64), q[b].astype(np.float64)
            # Whole numbers below 2 ** 53: the first block within its share owns the pair.
            within = np.add.reduceat((p - r) ** 2, starts, axis=1) <= share
            mine = within.argmax(axis=1) == block
            a, b = a[mine], b[mine]
            cos = np.einsum("ij,ij->i", p[mine], r[mine]) / STEPS**2
            sure = cos >= cosine + doubtful
            unsure = ~sure & (cos >= cosine - doubtful)
            maybe.append((a[unsure], b[unsure]))
            a, b = a[sure], b[sure]
            np.add.at(total, a, size[b])
            np.add.at(total, b, size[a])
            groups.join(a, b)

    held, waiting = 0, []
    first, rest = np.arange(len(homes)), np.arange(len(homes), len(rows))
    for u, v in close_pairs(x, first, rest, share[block] / STEPS**2, inside):
        if len(u):
            waiting.append((u, v))
            held += len(u)
        if held >= 32_768:
            settle(*map(np.concatenate, zip(*waiting)))
            held, waiting = 0, []
    if waiting:
        settle(*map(np.concatenate, zip(*waiting)))
    summed = np.flatnonzero(total)
    doubt_a, doubt_b = (np.concatenate([m[k] for m in maybe] or [np.empty(0, np.int64)]) for k in (0, 1))
    kind = np.repeat(np.array([SUM, LINK, MAYBE], np.int8), [len(summed), len(groups.a), len(doubt_a)])
    a = np.concatenate([node[summed], node[np.array(groups.a, np.int64)], node[doubt_a]])
    b = np.concatenate([total[summed], node[np.array(groups.b, np.int64)], node[doubt_b]])
    return kind, a, b


def _units(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, d)


def plant(classes: DataFrame, cuts: dict[int, int]) -> dict[int, list]:
    """The cells of every block, for those lengths that are cut at all, from one sample."""
    if not cuts:
        return {}
    wanted = F.octet_length("unit").isin([8 * d for d in cuts])
    bytes_all = classes.filter(wanted).agg(F.sum(F.octet_length("unit").cast("bigint"))).first()[0]
    share = math.ceil(1_000_000 * min(1.0, SAMPLE_BYTES / bytes_all))
    some = classes.filter(wanted & (F.pmod(F.xxhash64("class"), F.lit(1_000_000)) < share)).select("unit").toArrow()["unit"]
    units = some.to_pylist()
    trees = {}
    for d, number in cuts.items():
        own = [u for u in units if len(u) == 8 * d]
        x = in_steps(np.frombuffer(b"".join(own), np.float64).reshape(-1, d)).astype(np.float64) / STEPS
        trees[d] = [grow(x[:, s : s + BLOCK], number) for s in block_starts(d)]
    return trees


VISITS = "d int, block int, cell bigint, i int, j int, home boolean, records binary"


def visits(batches: Iterator[pa.RecordBatch], trees: dict, parts: dict | None, cosine: float) -> Iterator[pa.RecordBatch]:
    """Where the vectors go. Without ``parts`` only numbers: ``(d, block, cell, homes, visitors)``.

    Visits grow with the cells, so they leave in batches of about ``SENT_BYTES``, and no more than
    ``REACH`` pairs of a vector and a cell are looked at together.
    """
    names = ["d", "block", "cell", "homes", "visitors"] if parts is None else ["d", "block", "cell", "i", "j", "home", "records"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), *([pa.int64()] * 2 if parts is None else [pa.int32(), pa.int32(), pa.bool_(), pa.binary()])]
    for packed in _packs(batches):
        lengths = np.array([len(u) // 8 for u in packed.column("unit").to_pylist()])
        for d in np.unique(lengths).tolist():
            own = packed.take(pa.array(np.flatnonzero(lengths == d)))
            rows = np.empty(own.num_rows, dtype=record(d))
            rows["node"], rows["size"] = own.column("node").to_numpy(), own.column("size").to_numpy()
            rows["q"] = in_steps(_units(own.column("unit"), d))
            out: list[tuple] = []
            held = 0
            for row in _visits_of(d, rows, trees, parts, cosine):
                out.append(row)
                held += 64 + (len(row[-1]) if parts is not None else 0)
                if held >= SENT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names)


def _visits_of(d: int, rows: np.ndarray, trees: dict, parts: dict | None, cosine: float) -> Iterator[tuple]:
    """The rows of ``visits`` for vectors of one length."""
    share = budgets(d, cosine) / STEPS**2
    for block, s in enumerate(block_starts(d)):
        tree = trees[d][block] if d in trees else None
        step = max(1, REACH // cells(tree))
        for first in range(0, len(rows), step):
            x = rows["q"][first : first + step, s : s + BLOCK].astype(np.float64) / STEPS
            at, cell, lives = visit(tree, x, share[block])
            order = np.argsort(cell, kind="stable")
            at, cell, lives = first + at[order], cell[order], lives[order]
            bounds = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
            for start, end in zip(bounds, bounds[1:]):
                c = int(cell[start])
                homes, others = at[start:end][lives[start:end]], at[start:end][~lives[start:end]]
                if parts is None:
                    yield d, block, c, len(homes), len(others)
                else:
                    k, m = parts.get((d, block, c), (1, 0))
                    yield from _dealt((d, block, c), rows, homes, others, k, m)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to ``PACK`` rows or ``SAMPLE_BYTES``."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= PACK or size >= SAMPLE_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _dealt(cell: tuple, rows: np.ndarray, homes: np.ndarray, others: np.ndarray, k: int, m: int) -> Iterator[tuple]:
    """Rows of a cell for its tasks ``(i, j)``. In a cell of ``k`` home parts and ``m`` parts of
    visitors, task (i, i) compares a part with itself, (i, j) two parts, (i, k + j) it with visitors."""
    give = lambda i, j, home, chosen: (*cell, i, j, home, rows[chosen].tobytes())
    if k == 1 and m == 0:
        for home, chosen in ((True, homes), (False, others)):
            if len(chosen):
                yield give(0, 0, home, chosen)
        return
    for i in range(k):
        part = homes[rows["node"][homes] % k == i]
        if len(part):
            for j in range(i, k + m):
                yield give(i, j, True, part)
            for j in range(i):
                yield give(j, i, False, part)
    for j in range(m):
        part = others[rows["node"][others] % m == j]
        if len(part):
            for i in range(k):
                yield give(i, k + j, False, part)


def range_join(classes: DataFrame, trees: dict, most: int, cosine: float) -> DataFrame:
    """``(kind, a, b)`` of all cells, see ``compare``; no cell holds more than ``most`` vectors."""
    shared = classes.sparkSession.sparkContext.broadcast(trees)
    slim = classes.select("node", "size", "unit")
    counted = slim.mapInArrow(
        lambda it: visits(it, shared.value, None, cosine), "d int, block int, cell bigint, homes bigint, visitors bigint"
    )
    counts = counted.groupBy("d", "block", "cell").agg(F.sum("homes").alias("homes"), F.sum("visitors").alias("visitors"))
    # At most a row per cell, whose number the sample bounds.
    large = counts.filter(F.col("homes") + F.col("visitors") > CHUNK).collect() if most > CHUNK else []
    parts = {
        (r["d"], r["block"], r["cell"]): (math.ceil(r["homes"] / CHUNK) or 1, math.ceil(r["visitors"] / CHUNK)) for r in large
    }
    dealt = slim.mapInArrow(lambda it: visits(it, shared.value, parts, cosine), VISITS)

    def meet(key: tuple, whole: pa.Table) -> pa.Table:
        d, block = key[0].as_py(), key[1].as_py()
        home = whole.column("home").to_pylist()
        packs = whole.column("records").to_pylist()
        sides = [np.frombuffer(b"".join(p for p, h in zip(packs, home) if h == want), record(d)) for want in (True, False)]
        inside = key[3].as_py() == key[4].as_py()
        kind, a, b = compare(*sides, block, cosine, inside) if len(sides[0]) else (np.empty(0, np.int8), *[np.empty(0, np.int64)] * 2)
        return pa.table({"kind": pa.array(kind), "a": pa.array(a), "b": pa.array(b)})

    return dealt.groupBy("d", "block", "cell", "i", "j").applyInArrow(meet, "kind byte, a bigint, b bigint")


def verified(found: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """Of the doubtful pairs those with the cosine in double precision: ``(a, b, size_a, size_b)``."""
    side = lambda name: classes.select(
        F.col("node").alias(name), F.col("unit").alias(f"unit_{name}"), F.col("size").alias(f"size_{name}")
    )
    pairs = attach(found.filter(F.col("kind") == MAYBE).select("a", "b"), side("a"), ["a"], ["b"], "inner")
    pairs = attach(pairs, side("b"), ["b"], ["a"], "inner")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = zip(batch.column("unit_a").to_pylist(), batch.column("unit_b").to_pylist())
            fine = [float(np.dot(np.frombuffer(x), np.frombuffer(y))) >= cosine for x, y in units]
            kept = batch.filter(pa.array(fine, pa.bool_()))
            yield kept.select(["a", "b", "size_a", "size_b"])

    return pairs.mapInArrow(keep, "a bigint, b bigint, size_a bigint, size_b bigint")


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row for each row of ``df``."""
    units = stored(unit_vectors(df, key, vector), "units")
    able = units.filter("class IS NOT NULL AND vec_id IS NOT NULL")
    distinct = able.groupBy("class").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("size"), F.first("unit").alias("unit"))
    classes = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "classes")
    # A row per length that needs cuts: no more of them than vectors by cells.
    lengths = classes.groupBy((F.octet_length("unit") / 8).cast("int").alias("d")).count().filter(F.col("count") > CELL).collect()
    cuts = {r["d"]: math.ceil(math.log2(r["count"] / CELL)) for r in lengths}
    most = max([r["count"] for r in lengths], default=0)
    found = stored(range_join(classes, plant(classes, cuts), most, cosine), "cell_links")
    decided = stored(verified(found, classes, cosine), "verified")
    sums = found.filter(F.col("kind") == SUM).select("a", "b").union(
        decided.select("a", "size_b")).union(decided.select("b", "size_a"))
    sums = sums.groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("n"))
    links = found.filter(F.col("kind") == LINK).select("a", "b").union(decided.select("a", "b"))
    groups = components(links).join(classes.select("node", "first"), "node")
    groups = stored(groups, "groups")
    least = groups.groupBy("component").agg(F.min("first").alias("least"))
    groups = attach(groups, least, ["component"], ["node"], "inner").select("node", "least")
    named = classes.select("class", "node", "first", "size").join(sums, "node", "left").join(groups, "node", "left")
    named = stored(
        named.select(
            "class", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("least", "first").alias("component_id")
        ),
        "named",
    )
    # Rows of a large class are spread.
    out = attach(units.select("vec_id", "class"), named, ["class"], ["vec_id"])
    known = F.col("vec_id").isNotNull()
    component = F.when(known, F.coalesce("component_id", "vec_id"))
    n_links = F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint")
    return out.select(
        "vec_id", n_links.alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def op7_vector_join(spark, sf_dir) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
