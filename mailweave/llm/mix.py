"""Mixing sources to target weights by systematic sampling.

Every source has a target, and so every document of it the same expected number of copies,
target / source size. The documents of a source are laid out in the order of their size; their
expected copies are summed from the start, one random offset is added, and a document is
emitted once for every whole number its stretch reaches. As neighbours in that order are of
like size, the words taken stay within about one document of the target.

The prefix sums never bring a source into one task: a source is cut into cells of like size
(whole square root of the size), a large cell into salted parts, and a part starts at the number
of rows in the parts before it. Parts hold about the square root of the number of rows, whatever
the source's share. Only counts per cell and part are gathered.

Edge cases: a null source is a source of its own, the last one. A null size counts 0. Sources
without words get target 0 and no copies. Repeated rows are rows of their own; those with one id
stand in the order of their size and content. Extra columns are kept, whatever their names: an
added column whose name is taken has underscores before it, and the added ones are the last three.
An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm.common import fresh, table, words
from mailweave.operators.joins import attach
from mailweave.session import stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
SEED = "mix"


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """``(source, source_size)`` -> plus ``target``.

    Sources in code-point order, null last, take the weights in turn. The level at which the
    total is reached is found by adding up sources in the order in which they fill: those
    filled below the level stop at ``cap`` times their size. One row per source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(ordered) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    most = F.col("source_size") * F.lit(cap)
    rows = sizes.withColumn("_w", weight).withColumn("_most", most)
    filling = Window.orderBy(F.col("_most") / F.col("_w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    rows = rows.withColumn("_level", left / F.sum("_w").over(onward))
    rows = rows.withColumn("_full", F.col("_most") <= F.col("_w") * F.col("_level"))
    level = F.min(F.when(~F.col("_full"), F.struct(F.col("_most") / F.col("_w"), "_level"))).over(every)
    target = F.when(F.col("_full"), F.col("_most")).otherwise(F.col("_w") * level["_level"])
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def systematic_mix(
    rows: DataFrame,
    source: str = "source",
    size: str = "size",
    key: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: str = SEED,
) -> DataFrame:
    """All columns of ``rows`` and, last, ``source_size, target, copies``; reruns agree.

    ``key`` orders rows of like size at random, by its hash; ``rows`` is read three times, so a
    caller with costly sizes stores them first.
    """
    whole, aim, taken, s, z, cell, salts, part, h, start, place, content = fresh(
        rows, "source_size", "target", "copies", "_s", "_z", "_cell", "_salts", "_part", "_h", "_start", "_place", "_content"
    )
    simple = [f"`{f.name}`" for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    name = F.col(f"`{source}`")
    n = F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("bigint")
    own = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    # A null source needs a key that joins: 'n', while others begin with 's'.
    laid = rows.select(
        "*",
        F.when(name.isNull(), "n").otherwise(F.concat(F.lit("s"), name.cast("string"))).alias(s),
        n.alias(z),
        F.floor(F.sqrt(n.cast("double"))).cast("bigint").alias(cell),
        F.md5(F.concat(F.lit(f"{seed}/"), own).cast("binary")).alias(h),
        F.xxhash64(*simple).alias(content),
    )
    cells = stored(
        laid.groupBy(s, cell).agg(F.count(F.lit(1)).alias("_n"), F.sum(z).alias("_size")), "mix_cells"
    )
    total = cells.agg(F.sum("_n")).first()[0] or 0
    per_part = max(1, math.ceil(math.sqrt(total)))
    # Large cells are split by the hash, at random and in as many parts as they need.
    split = cells.select(s, cell, F.ceil(F.col("_n") / F.lit(float(per_part))).cast("bigint").alias(salts))
    chance = F.conv(F.substring(h, 1, 6), 16, 10).cast("bigint")
    parted = (
        attach(laid, split, [s, cell], [h], how="inner")
        .withColumn(part, chance % F.col(salts))
        .drop(salts)
    )
    counts = parted.groupBy(s, cell, part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(s).orderBy(cell, part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        s, cell, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias(start)
    )
    sizes = cells.groupBy(s).agg(F.sum("_size").cast("bigint").alias("source_size"))
    real = F.when(F.col(s) != "n", F.expr(f"substring(`{s}`, 2)"))
    targets = source_targets(sizes.select(real.alias("source"), "source_size"), weights, share, cap)
    again = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source")))
    targets = targets.select(again.alias(s), F.col("source_size").alias(whole), F.col("target").alias(aim))
    starts = attach(starts, targets, [s], [cell, part], how="inner")

    order = Window.partitionBy(s, cell, part).orderBy(h, F.col(f"`{key}`"), z, content)
    placed = (
        attach(parted, starts, [s, cell, part], [h], how="inner")
        .withColumn(place, F.col(start) + F.row_number().over(order) - 1)
    )
    offset = _fraction(F.md5(F.concat(F.lit(f"{seed}/source/"), F.col(s)).cast("binary")))
    rate = F.when(F.col(whole) > 0, F.col(aim) / F.col(whole)).otherwise(0.0)
    up_to = lambda i: F.floor(i.cast("double") * rate + offset)
    copies = (up_to(F.col(place) + 1) - up_to(F.col(place))).cast("bigint")
    columns = [F.col(f"`{c}`") for c in [*rows.columns, whole, aim]]
    return placed.select(*columns, copies.alias(taken))


def _fraction(digest: Column) -> Column:
    """A number from 0 to 1 out of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """Each row of ``systematic_mix`` as often as it was taken, without the three added columns."""
    *own, _, _, taken = mixed.columns
    (each,) = fresh(mixed, "_copy")
    times = F.explode(F.sequence(F.lit(1), F.col(f"`{taken}`").cast("int")))
    out = mixed.filter(F.col(f"`{taken}`") > 0).withColumn(each, times)
    return out.select(*[F.col(f"`{c}`") for c in own])


def op6_mix_sources(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.size(words(F.col("text"))).cast("bigint")
    sized = stored(docs.select("doc_id", "source", size.alias("size")), "mix_sizes")
    mixed = systematic_mix(sized)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
  lambda x: x <> '')) AS BIGINT) AS size, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS s FROM documents),
c AS (SELECT *, CAST(floor(sqrt(size)) AS BIGINT) AS cell, md5('mix/' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM d),
p AS (SELECT *, CAST('0x' || substr(h, 1, 6) AS BIGINT)
  % CAST(ceil(count(*) OVER (PARTITION BY s, cell) / ceil(sqrt(count(*) OVER ()))) AS BIGINT) AS part FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY cell, part, h, doc_id) - 1 AS place FROM p),
t AS (SELECT s, source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY s, source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM t),
f AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY source_size / w, source NULLS LAST
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (SELECT *, 2.0::DOUBLE * source_size <= w * level AS is_full FROM f),
l AS (SELECT arg_min(level, source_size / w) AS level FROM g WHERE NOT is_full),
x AS (SELECT g.s, g.source_size, CASE WHEN is_full THEN 2.0::DOUBLE * source_size ELSE w * l.level END AS target,
  CAST('0x' || substr(md5('mix/source/' || s), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM g LEFT JOIN l ON true),
k AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate, u, place
  FROM r JOIN x USING (s))
SELECT doc_id, size, source_size, target,
CAST(floor((place + 1) * rate + u) - floor(place * rate + u) AS BIGINT) * size AS taken,
CAST(floor((place + 1) * rate + u) - floor(place * rate + u) AS BIGINT) AS copies FROM k"""
