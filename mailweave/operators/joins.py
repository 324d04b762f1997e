"""Joins whose plan depends on a measured side and that survive hot keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.session import stored

BROADCAST_CONF = "spark.mailweave.broadcastBytes"
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 500_000  # rows of a key in one task
HOT_KEYS = 10_000  # bounds the list of hot keys: no more keys can each hold this share of the rows
NULL_PARTS = 1000


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(BROADCAST_CONF, str(BROADCAST_BYTES)))


def _width(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):
        if isinstance(field.dataType.elementType, T.StringType):
            return F.coalesce(F.octet_length(F.array_join(col, "")), F.lit(0)) + 8 * F.size(col)
        return F.coalesce(F.size(col), F.lit(0)) * 8 + 16
    return F.lit(8)


ROW_BYTES = 64


def measured_bytes(df: DataFrame) -> int:
    """Approximate in-memory size, from one distributed aggregation."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(ROW_BYTES))
    return int(df.agg(F.sum(width.cast("bigint"))).first()[0] or 0)


def salted_join(
    big: DataFrame,
    side: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "inner",
) -> DataFrame:
    """Shuffle join in which the frequent keys of ``big`` are split.

    A key is hot above ``HOT_ROWS`` rows, or above the ``HOT_KEYS``-th part of all rows where that
    is more, so fewer than ``HOT_KEYS`` keys are hot. It gets as many parts as it holds that
    number of rows. Its rows are spread by a hash of the ``spread`` columns; the matching rows of
    ``side`` are copied to every part. All other keys keep the single part 0.
    ``how`` may be inner, left, left_semi or left_anti.
    """
    counts = stored(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key_counts")
    rows = counts.agg(F.sum("_rows")).first()[0] or 0
    share = max(HOT_ROWS, math.ceil(rows / HOT_KEYS))
    hot = counts.filter(F.col("_rows") > share).select(
        *keys, F.ceil(F.col("_rows") / F.lit(float(share))).cast("int").alias("_salts")
    )
    # A null key never matches, so its rows may go anywhere.
    unmatched = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(NULL_PARTS)) for k in keys])
    salts = F.coalesce(unmatched, F.col("_salts"), F.lit(1))
    part = F.pmod(F.xxhash64(*spread), salts).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    spread_big = big.join(F.broadcast(hot), keys, "left").withColumn("_salt", part).drop("_salts")
    copied = side.join(F.broadcast(hot), keys, "left").withColumn("_salt", parts).drop("_salts")
    return spread_big.join(copied, [*keys, "_salt"], how).drop("_salt")


def attach(
    big: DataFrame,
    side: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "left",
    size: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Join ``side`` to ``big``: broadcast when ``side`` is small, else salted.

    The size of ``side`` is measured, unless the caller knows a bound in bytes. With
    ``unique`` keys in ``big`` there is nothing to salt.
    """
    if (measured_bytes(side) if size is None else size) <= broadcast_limit(side):
        return big.join(F.broadcast(side), keys, how)
    if unique:
        return big.join(side, keys, how)
    return salted_join(big, side, keys, spread, how)
