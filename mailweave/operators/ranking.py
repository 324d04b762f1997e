"""Ranks and top-n per group, without putting a large group into one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailweave.operators.joins import attach
from mailweave.session import stored

WINDOW_CONF = "spark.mailweave.windowRows"
WINDOW_ROWS = 1_000_000
GROUP_LIMIT = 1000


TIE_SPLIT = 2.0**17 + 1


def tie_key(score):
    """``score`` rounded to 36 bits, about 11 digits; works on columns and arrays.

    Equal sums added up in another order differ in their last bits and must still tie.
    The rounding is relative, so the small steps of fused ranks stay apart.
    """
    split = score * TIE_SPLIT
    return split - (split - score)


def by_score(score: str = "score", tie: Column | str = "Id") -> list[Column]:
    """Ranking order: score down, then id up."""
    tie = F.col(tie) if isinstance(tie, str) else tie
    return [tie_key(F.col(score)).desc(), tie.asc()]


def _window_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(WINDOW_CONF, str(WINDOW_ROWS)))


def rank_within(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str = "rank",
    group_rows: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """0-based rank within each group.

    ``group_rows`` is a known bound on the rows of a group. Small groups use one window, and with
    a known number of all ``rows`` as many tasks as these need.
    Larger or unknown ones are range-partitioned on keys and order, so that a group spans
    as many tasks as it needs; each row then adds the number of rows of its group in the
    partitions before its own. The number of partitions follows the rows of all groups. The
    placed rows are stored first, because range bounds come from a sample and must not change
    between the two uses.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if group_rows is not None and group_rows <= _window_rows(df):
        if rows is not None and rows > parts * WINDOW_ROWS:
            df = df.repartition(math.ceil(rows / WINDOW_ROWS), *keys)
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, (F.row_number().over(w) - 1).cast("bigint"))

    df = stored(df, "unranked")
    parts = max(parts, math.ceil(df.count() / WINDOW_ROWS))
    placed = stored(
        df.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "placed",
    ).withColumn("_part", F.shiftright("_pos", 33))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stored(
        placed.groupBy(*keys, "_part")
        .agg(F.min("_pos").alias("_head"), F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            "_part",
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_head")).alias("_shift"),
        ),
        "shifts",
    )
    return (
        attach(placed, shifts, [*keys, "_part"], ["_pos"], "inner")
        .withColumn(name, F.col("_pos") + F.col("_shift"))
        .select(*df.columns, name)
    )


def top_n(
    df: DataFrame,
    keys: list[str],
    n: int,
    order: list[Column],
    name: str = "rank",
    group_rows: int | None = None,
) -> DataFrame:
    """First ``n`` rows of each group with their 0-based rank.

    Up to ``GROUP_LIMIT`` Spark keeps n rows per group in every task before the shuffle.
    """
    if n <= GROUP_LIMIT:
        w = Window.partitionBy(*keys).orderBy(*order)
        cut = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
        return cut.withColumn(name, (F.col(name) - 1).cast("bigint"))
    return rank_within(df, keys, order, name, group_rows).filter(F.col(name) < n)


def first_n(df: DataFrame, keys: list[str], n: int, order: list[Column]) -> DataFrame:
    """First ``n`` rows of each group, without their rank: beyond ``GROUP_LIMIT`` the rows are counted,
    and only groups of more than ``n`` rows are ranked."""
    if n <= GROUP_LIMIT:
        return top_n(df, keys, n, order, "_rank").drop("_rank")
    df = stored(df, "uncut")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > n)
    long = stored(sizes.withColumnsRenamed({k: f"_{k}" for k in keys}), "long_groups")
    most = long.agg(F.max("_rows")).first()[0]
    if most is None:
        return df
    # The keys of a group may be null.
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    cut = top_n(df.join(long, same, "left_semi"), keys, n, order, "_rank", most).drop("_rank")
    return df.join(long, same, "left_anti").unionByName(cut)


def rank_all(
    scores: DataFrame, keys: list[str], group_rows: int | None = None
) -> DataFrame:
    """Complete ranking of every group by score."""
    return rank_within(scores, keys, by_score(), "rank", group_rows)


def number_docs(corpus: DataFrame, order_col: str = "Id") -> DataFrame:
    """1-based ``doc_no`` per folder in the order of ``order_col``."""
    ranked = rank_within(corpus, ["folder"], [F.col(order_col).asc()], "doc_no")
    return ranked.withColumn("doc_no", F.col("doc_no") + 1)


def hit_cap(corpus: DataFrame) -> int:
    """Number of keyword hits per folder and query that loses none: the mails of the largest
    folder, 500 at least."""
    sizes = corpus.groupBy("folder").agg(F.count(F.lit(1)).alias("n"))
    return max(sizes.agg(F.max("n")).first()[0] or 0, 500)
