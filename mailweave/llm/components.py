"""Connected components of a table of links: trees within tasks, then alternating stars.

Each task first turns its links, a bounded number, into stars around the least node of what they
connect. Links that fit one task are settled by that. With more of them, every further step is a
grouping and joins over the links. Each round is written to the shared folder, so lost executors
repeat one round at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.session import stored

LINKS_PER_TASK = 100_000  # that a task holds at once


def root(parent: dict[int, int], x: int) -> int:
    """The node at the top of ``x``'s tree; nodes without a parent are missing or their own."""
    while parent.get(x, x) != x:
        parent[x] = parent.get(parent[x], parent[x])
        x = parent[x]
    return x


def within_tasks(edges: DataFrame, most: int) -> DataFrame:
    """``(u, v)`` -> every node of up to ``most`` links of a task, with the least node that these links lead to."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            nodes = np.fromiter(parent, np.int64, len(parent))
            tops = np.fromiter((root(parent, x) for x in parent), np.int64, len(parent))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(tops)], names=["u", "v"])

        for whole in batches:
            for first in range(0, whole.num_rows, most):
                batch = whole.slice(first, most)
                if held + batch.num_rows > most:
                    yield from out()
                    parent.clear()
                    held = 0
                held += batch.num_rows
                for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                    p, q = root(parent, u), root(parent, v)
                    parent.setdefault(p, p)
                    parent.setdefault(q, q)
                    parent[max(p, q)] = min(p, q)
        yield from out()

    return edges.mapInArrow(trees, "u bigint, v bigint")


def _to_least(pairs: DataFrame) -> DataFrame:
    """``(u, v)`` -> plus the least neighbour of u, or u itself. Written first, so that the join
    has two plain sides and Spark can split the rows of a hub."""
    least = stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")
    return pairs.join(least.select("u", F.least("u", "m").alias("m")), "u")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link; ``component`` is its least node."""
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v")
    )
    edges = stored(edges, "links")
    tasks = math.ceil(edges.count() / LINKS_PER_TASK)
    edges = stored(within_tasks(edges.coalesce(max(tasks, 1)), LINKS_PER_TASK), "links")
    if tasks <= 1:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    edges = edges.filter("u > v")
    seen = None
    while True:
        facts = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(facts) == seen or facts[0] == 0:
            break
        seen = tuple(facts)
        # Every node hands its larger neighbours to its least one,
        both = stored(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links")
        large = _to_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = stored(large, "links")
        # then its smaller neighbours and itself.
        met = _to_least(large)
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(met.select("u", F.col("m").alias("v")))
        edges = stored(small.filter("u > v").distinct(), "links")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stored(members.union(roots).distinct(), "components")
