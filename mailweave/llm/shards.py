"""Uniform shuffle into shards of exact sizes, by a drawn matrix of partition-to-shard counts.

If all rows were shuffled uniformly and cut into shards, the number of rows that go from
partition p to shard k would follow a multivariate hypergeometric law. Those counts are drawn
first; each partition then deals its rows to shards in a random order that keeps its counts
(a permutation of labels, so rows just stream by), the rows are exchanged, and each shard is
put into random order. The shards are within one row of each other, and any assignment is as
likely as any other.

The counts are drawn in two levels: on the driver only for chunks of partitions, and within a
chunk by the tasks themselves, from seeds, so no matrix is sent around. A shard is cut into
parts, so it is never sorted by one task; where a part starts follows from the same seeds.

Partitions must hold the same rows each time they are computed. That is so for a scan of
files; for any other input set ``store_first``. A partition that differs raises an error.

Edge cases: null ids and texts are rows like others (size 16, the crc32 of no bytes is 0).
Repeated rows are dealt one by one. Extra columns are kept; a column called ``shard`` or
``slot`` is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm.common import fresh, table
from mailweave.operators.joins import attach
from mailweave.session import stored

CHUNK = 1000
PART_ROWS = 4096
NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """An exact draw also where numpy's limit of 10^9 is passed, by ratio of uniforms."""
    total = good + bad
    if draws <= 0 or good <= 0:
        return 0
    if bad <= 0 or draws >= total:
        return min(draws, good)
    if total < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(draws, good)
    p = good / total
    mean = draws * p
    deviation = math.sqrt(mean * (1 - p) * (total - draws) / (total - 1) + 0.5)
    lg = math.lgamma
    log_mass = lambda k: -(lg(k + 1) + lg(good - k + 1) + lg(draws - k + 1) + lg(bad - draws + k + 1))
    peak = log_mass(min(high, max(low, int((draws + 1) * (good + 1) / (total + 2)))))
    while True:
        u, v = 1.0 - rng.random(), rng.random()
        k = math.floor(mean + 0.5 + (2 * v - 1) * (1.8 * deviation + 1.5) / u)
        if low <= k <= high and 2 * math.log(u) <= log_mass(k) - peak:
            return k


def deal(rng: np.random.Generator, rows: np.ndarray, shards: np.ndarray) -> np.ndarray:
    """Matrix of counts with the given row and column sums, as a uniform shuffle has it."""
    left = shards.astype(np.int64).copy()
    out = np.zeros((len(rows), len(left)), dtype=np.int64)
    for p, need in enumerate(rows.tolist()):
        rest = int(left.sum())
        for k in range(len(left)):
            rest -= int(left[k])
            out[p, k] = hypergeometric(rng, int(left[k]), rest, need)
            need -= int(out[p, k])
        left -= out[p]
    return out


class Plan:
    """What a task needs to label its rows: counts per partition and per chunk, and a seed."""

    def __init__(self, counts: np.ndarray, n_shards: int, seed: int) -> None:
        self.counts, self.n_shards, self.seed = counts, n_shards, seed
        total = int(counts.sum())
        sizes = np.full(n_shards, total // n_shards) + (np.arange(n_shards) < total % n_shards)
        chunks = np.add.reduceat(counts, np.arange(0, len(counts), CHUNK)) if len(counts) else counts
        self.chunk_rows = deal(np.random.default_rng([seed, 0]), chunks, sizes)
        self.parts = max(1, math.ceil(int(sizes.max()) / PART_ROWS))

    def labels(self, partition: int) -> tuple[np.ndarray, np.ndarray]:
        """Shard and part of every row of a partition."""
        chunk = partition // CHUNK
        first = chunk * CHUNK
        rng = np.random.default_rng([self.seed, 1, chunk])
        matrix = deal(rng, self.counts[first : first + CHUNK], self.chunk_rows[chunk])
        own = matrix[partition - first]
        rng = np.random.default_rng([self.seed, 2, partition])
        shards = rng.permutation(np.repeat(np.arange(self.n_shards, dtype=np.int32), own))
        return shards, rng.integers(0, self.parts, len(shards), dtype=np.int32)


def uniform_shards(
    df: DataFrame, n_shards: int = 40, seed: int = 0, store_first: bool = False
) -> DataFrame:
    """All columns of ``df`` with ``shard int`` (0 to ``n_shards`` - 1) and ``slot long``."""
    df = df.drop("shard", "slot")
    if store_first:
        df = stored(df, "shard_input")
    spark = df.sparkSession
    part, where, start = fresh(df, "_part", "_at", "_start")
    # The counts read no column. One row per partition comes to the driver.
    found = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    counts = np.zeros(max([r["p"] for r in found], default=-1) + 1, dtype=np.int64)
    for r in found:
        counts[r["p"]] = r["count"]
    plan = Plan(counts, n_shards, seed)
    shared = spark.sparkContext.broadcast(plan)

    added = [T.StructField("shard", T.IntegerType()), T.StructField(part, T.IntegerType()),
             T.StructField(where, T.LongType())]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        known = shared.value
        want = int(known.counts[partition]) if partition < len(known.counts) else 0
        shards, parts = known.labels(partition) if want else (np.empty(0, np.int32), np.empty(0, np.int32))
        done = 0
        for batch in batches:
            n = batch.num_rows
            if done + n > want:
                raise ValueError("a partition has other rows than when it was counted: set store_first")
            # Random order within a part, without keeping rows: a key drawn per row.
            keys = np.random.default_rng([known.seed, 3, partition, done]).integers(0, 2**62, n)
            columns = [*batch.columns, pa.array(shards[done : done + n]), pa.array(parts[done : done + n]), pa.array(keys)]
            names = [*batch.schema.names, "shard", part, where]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            done += n
        if done != want:
            raise ValueError("a partition has other rows than when it was counted: set store_first")

    dealt = df.mapInArrow(label, T.StructType([*df.schema.fields, *added]))

    def count_parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame["p"].tolist():
                shards, parts = shared.value.labels(p)
                yield pd.DataFrame({"shard": shards, part: parts}).groupby(["shard", part]).size().reset_index(name="n")

    # How many rows each part gets follows from the seeds; no data is read for it.
    listed = spark.createDataFrame([(int(p),) for p in np.nonzero(counts)[0]], "p int")
    sizes = listed.mapInPandas(count_parts, f"shard int, `{part}` int, n bigint").groupBy("shard", part).agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        sizes.select("shard", part, F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias(start)),
        "shard_starts",
    )
    inside = Window.partitionBy("shard", part).orderBy(where)
    return (
        attach(dealt, starts, ["shard", part], [where], how="inner", size=plan.parts * n_shards * 64)
        .withColumn("slot", (F.col(start) + F.row_number().over(inside) - 1).cast("bigint"))
        .select(*[F.col(f"`{c}`") for c in df.columns], "shard", "slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in the order of their slots within every file."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


def op8_shards(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return uniform_shards(docs).select(
        "doc_id",
        (F.octet_length(data) + 16).cast("bigint").alias("size"),
        F.crc32(data).cast("bigint").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
