"""Reciprocal rank fusion, score normalisation and the weighted combination of rankings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.functions.text import query_len
from mailweave.functions.vectors import semantic_weight
from mailweave.operators.dense import RANKS_PER_QUERY
from mailweave.operators.joins import ROW_BYTES, attach, broadcast_limit
from mailweave.operators.mailbox import FOLDERS
from mailweave.operators.ranking import GROUP_LIMIT, by_score, number_docs, rank_within, tie_key, top_n
from mailweave.session import stored

RRF_K = 60
BITS = 63  # queries in one number
KEYS = ["folder", "qid"]


def rrf(ranked: DataFrame, k: int = RRF_K) -> DataFrame:
    """``(folder, qid, Id, score)``: sum of ``1 / (k + rank + 1)`` over the query variants.

    A row of ``ranked`` holds one rank of a mail, or all its ``ranks``, which are summed in place.
    """
    if "ranks" in ranked.columns:
        total = F.aggregate("ranks", F.lit(0.0), lambda total, rank: total + 1.0 / (rank + F.lit(k + 1)))
        return ranked.select("folder", "qid", "Id", total.alias("score"))
    gain = 1.0 / (F.col("rank") + F.lit(k + 1))
    return ranked.groupBy("folder", "qid", "Id").agg(F.sum(gain).alias("score"))


def scaled(value: Column, low: Column, high: Column) -> Column:
    """Min-max scaling; equal bounds give 0."""
    return F.when(high == low, 0.0).otherwise((value - low) / (high - low))


def min_max(df: DataFrame, key: str = "qid", score: str = "score") -> DataFrame:
    """Add ``norm``, the score scaled to [0, 1] within each group.

    The scores are stored, as bounds, their size and the join each read them.
    """
    df = stored(df, "unscaled")
    bounds = df.groupBy(key).agg(F.min(score).alias("_low"), F.max(score).alias("_high"))
    spread = [c for c in df.columns if c != key]
    return attach(df, bounds, [key], spread).withColumn(
        "norm", scaled(F.col(score), F.col("_low"), F.col("_high"))
    ).drop("_low", "_high")


def _filled(stats: DataFrame, part: str) -> DataFrame:
    """Bounds after filling absent mails with 0, and the scaled value of such a mail."""
    partial = F.col(f"{part}_n") < F.col("n_docs")
    low, high = F.col(f"{part}_low"), F.col(f"{part}_high")
    stats = stats.withColumn(
        f"{part}_lo", F.when(partial, F.least(low, F.lit(0.0))).otherwise(low)
    ).withColumn(f"{part}_hi", F.when(partial, F.greatest(high, F.lit(0.0))).otherwise(high))
    zero = scaled(F.lit(0.0), F.col(f"{part}_lo"), F.col(f"{part}_hi"))
    return stats.withColumn(f"{part}_zero", F.when(F.col(f"{part}_n") > 0, zero).otherwise(0.0))


def combine(
    sem: DataFrame | None,
    kw: DataFrame | None,
    queries: DataFrame,
    corpus: DataFrame,
    n: int | None = None,
    hits_only: bool = False,
) -> DataFrame:
    """``(folder, qid, Id, score, rank)`` from semantic and keyword scores.

    Both lists are min-max scaled as if every mail of the folder without a score had 0,
    and blended by the query length. That fill is not materialised: it only moves the
    bounds, and gives all unscored mails one common score. They are added when they are
    needed for ``n`` rows (``hits_only=True`` leaves them out); ``n=None`` ranks the folder. That is
    done a query and folder at a time where the ids of all mails are few enough to be held by every task.
    """
    if n is None:
        ranked = _ranked_per_query(sem, kw, queries, corpus, hits_only)
        if ranked is not None:
            return ranked
    none = F.lit(None).cast("double")
    parts = [
        sem.select(*KEYS, "Id", F.col("score").alias("sem")) if sem is not None else None,
        kw.select(*KEYS, "Id", F.col("score").alias("kw")) if kw is not None else None,
    ]
    if parts[0] is not None and parts[1] is not None:
        merged = parts[0].join(parts[1], [*KEYS, "Id"], "full")
    elif parts[0] is not None:
        merged = parts[0].withColumn("kw", none)
    elif parts[1] is not None:
        merged = parts[1].withColumn("sem", none)
    else:
        raise ValueError("at least one ranking is needed")

    merged = stored(merged, "scores")
    bounds = merged.groupBy(*KEYS).agg(*bounds_of("sem"), *bounds_of("kw"))
    scored, stats = blended(merged, bounds, queries, corpus, n, hits_only)
    if n is not None and n <= GROUP_LIMIT:
        return top_n(scored, KEYS, n, by_score())
    group_rows, rows = (x or 0 for x in stats.agg(F.max("n_docs"), F.sum("n_docs")).first())
    if n is None:
        return rank_within(scored, KEYS, by_score(), group_rows=group_rows, rows=rows)
    return top_n(scored, KEYS, n, by_score(), group_rows=group_rows)


def _ranked_per_query(
    sem: DataFrame | None, kw: DataFrame | None, queries: DataFrame, corpus: DataFrame, hits_only: bool
) -> DataFrame | None:
    """``combine`` for full rankings, by a task that holds the ids of all mails and the scores of one query
    and folder at a time, so that scores are shuffled once and nothing else is; None where the mails or the
    queries are too many for that."""
    sides = [df.select(*KEYS, "Id", F.col("score").cast("double").alias("score")) for df in (sem, kw) if df is not None]
    if not sides:
        return None
    held = corpus.select("folder", "Id").filter("folder IS NOT NULL")
    sizes = {r["folder"]: r["n"] for r in held.groupBy("folder").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = 8 * sum(sizes.values()) + queries.count() * ROW_BYTES
    kinds = (sides[0].join(sides[1], [*KEYS, "Id"], "full") if len(sides) == 2 else sides[0]).select(*KEYS, "Id").schema
    whole = all(isinstance(kinds[c].dataType, T.IntegralType) for c in ("qid", "Id"))
    if not whole or size > broadcast_limit(corpus) or max(sizes.values(), default=0) > RANKS_PER_QUERY:
        return None
    table = held.select("folder", F.col("Id").cast("bigint").alias("Id")).toArrow().combine_chunks()
    ids = {}
    for name in sizes:
        own = table.filter(pc.equal(table.column("folder"), name)).column("Id")
        ids[name] = (np.sort(own.drop_null().to_numpy()), own.null_count)
    weights: dict[int, list] = {}
    weighed = queries.select(F.col("qid").cast("bigint").alias("qid"), semantic_weight(query_len(F.col("query"))).alias("w"))
    for r in weighed.filter("qid IS NOT NULL").collect():
        weights.setdefault(r["qid"], []).append(r["w"])
    shared = corpus.sparkSession.sparkContext.broadcast((ids, weights))
    schema = T.StructType([*kinds, T.StructField("score", T.DoubleType()), T.StructField("rank", T.LongType())])
    alike = [df.select(*[F.col(f.name).cast(f.dataType) for f in kinds], "score") for df in sides]
    numbers = [(c, _WHOLE[kinds[c].dataType.typeName()]) for c in ("qid", "Id")]
    out = pa.schema([("folder", pa.string()), *numbers, ("score", pa.float64()), ("rank", pa.int64())])

    def rank(key: tuple, semantic: pa.Table | None, keyword: pa.Table | None) -> pa.Table:
        folder, qid = key[0].as_py(), key[1].as_py()
        if folder is None:
            return out.empty_table()
        merged = _full_join(_list(semantic), _list(keyword))
        mails = shared.value[0].get(folder)
        found = [_blend_lists(qid, *merged, w, mails, hits_only) for w in shared.value[1].get(qid, [None])]
        mails, null, score, unknown = (np.concatenate([f[k] for f in found]) for k in range(4))
        order = np.lexsort((mails, ~null))
        places = tie_key(score[order])
        places[np.isnan(places)] = np.inf  # as Spark sorts them
        order = order[np.lexsort((-places, unknown[order])) if unknown.any() else np.argsort(-places, kind="stable")]
        n = len(order)
        return pa.table(
            {
                "folder": pa.array([folder], pa.string()).take(pa.array(np.zeros(n, np.int32))),
                "qid": pa.array([qid], out.field("qid").type).take(pa.array(np.zeros(n, np.int32))),
                "Id": pa.array(mails[order], mask=null[order]).cast(out.field("Id").type),
                "score": pa.array(score[order], mask=unknown[order]),
                "rank": pa.array(np.arange(n)),
            },
            schema=out,
        )

    if len(alike) == 2:
        return alike[0].groupBy(*KEYS).cogroup(alike[1].groupBy(*KEYS)).applyInArrow(rank, schema)
    if sem is not None:
        return alike[0].groupBy(*KEYS).applyInArrow(lambda key, a: rank(key, a, None), schema)
    return alike[0].groupBy(*KEYS).applyInArrow(lambda key, b: rank(key, None, b), schema)


_WHOLE = {"byte": pa.int8(), "short": pa.int16(), "integer": pa.int32(), "long": pa.int64()}


def _list(table: pa.Table | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, whether one is null, scores, and whether there is one."""
    if table is None:
        return np.empty(0, np.int64), np.empty(0, bool), np.empty(0), np.empty(0, bool)
    flat = lambda name, zero, kind: pc.fill_null(table.column(name), zero).to_numpy().astype(kind, copy=False)
    return (
        flat("Id", 0, np.int64), table.column("Id").is_null().to_numpy(),
        flat("score", 0.0, np.float64), table.column("score").is_valid().to_numpy(),
    )


def _full_join(a: tuple, b: tuple) -> tuple:
    """Two lists as one by id, a null one met by none: ids, whether null, and for either list the
    scores and whether there is one."""
    names, place = np.unique(np.concatenate([a[0][~a[1]], b[0][~b[1]]]), return_inverse=True)
    p, q = np.full(len(a[0]), -1), np.full(len(b[0]), -1)
    p[~a[1]], q[~b[1]] = np.split(place, [int((~a[1]).sum())])
    counts = [np.bincount(x[x >= 0], minlength=len(names) + 1) for x in (p, q)]
    # A null id has the place -1, which is the last, with no rows.
    order = np.argsort(q, kind="stable")
    start = np.concatenate([[0], np.cumsum(counts[1])[:-1]]) + int((q < 0).sum())
    times = np.maximum(counts[1][p], 1)
    rows = np.repeat(np.arange(len(p)), times)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
    met = counts[1][p[rows]] > 0
    other = np.full(len(rows), -1)
    other[met] = order[start[p[rows[met]]] + nth[met]]
    alone = np.flatnonzero(counts[0][q] == 0)
    rows, other = np.concatenate([rows, np.full(len(alone), -1)]), np.concatenate([other, alone])
    pick = lambda values, at, none: np.where(at >= 0, values[at], none) if len(values) else np.full(len(at), none)
    ids = np.where(rows >= 0, pick(a[0], rows, 0), pick(b[0], other, 0))
    null = np.where(rows >= 0, pick(a[1], rows, False), pick(b[1], other, False))
    return ids, null, (pick(a[2], rows, 0.0), pick(a[3], rows, False)), (pick(b[2], other, 0.0), pick(b[3], other, False))


def _blend_lists(
    qid: int | None, ids: np.ndarray, null: np.ndarray, sem: tuple, kw: tuple, length_weight: float | None, mails: tuple | None, hits_only: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, whether null, blended scores, and whether these are null, of the rows of a query and of the mails
    of the folder without one. As ``blended`` has it for tables, where the scores of a null query are met by none."""
    n_docs = None if mails is None else len(mails[0]) + mails[1]
    values, zeros, numbers = [], [], []
    for score, there in (sem, kw):
        own, n = score[there], int(there.sum())
        partial = n_docs is not None and n < n_docs
        # Of numbers and NaN, the latter counts as the greatest.
        low = np.fmin.reduce(own) if n else 0.0
        high = own.max() if n else 0.0
        if partial:
            low, high = np.fmin(low, 0.0), np.maximum(high, 0.0)
        flat = low == high or (np.isnan(low) and np.isnan(high))
        scale = lambda x: np.zeros_like(x) if flat or not n else (x - low) / (high - low)
        values.append(scale(np.where(there, score, 0.0)))
        zeros.append(float(scale(np.zeros(1))[0]))
        numbers.append(n)
    both = numbers[0] > 0 and numbers[1] > 0
    unknown = both and length_weight is None
    w = (np.nan if unknown else length_weight) if both else 1.0 if numbers[0] else 0.0
    score = w * values[0] + (1.0 - w) * values[1]
    if qid is None:
        ids, null, score = ids[:0], null[:0], score[:0]
    if not hits_only and n_docs is not None and max(numbers) < n_docs:
        left = mails[0][~np.isin(mails[0], ids[~null])]
        ids = np.concatenate([ids, left, np.zeros(mails[1], np.int64)])
        null = np.concatenate([null, np.zeros(len(left), bool), np.ones(mails[1], bool)])
        score = np.concatenate([score, np.full(len(left) + mails[1], w * zeros[0] + (1.0 - w) * zeros[1])])
    return ids, null, score, np.full(len(ids), unknown)


def bounds_of(part: str) -> list[Column]:
    """Least and greatest score of a list and the number of its mails."""
    return [f(part).alias(f"{part}_{name}") for f, name in ((F.min, "low"), (F.max, "high"), (F.count, "n"))]


def blended(
    merged: DataFrame, bounds: DataFrame, queries: DataFrame, corpus: DataFrame, n: int | None, hits_only: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(folder, qid, Id, score)`` of the rows ``merged(folder, qid, Id, sem, kw)``, and of
    unscored mails where they are needed for ``n`` rows, and the stored facts of every query.

    ``bounds`` are those of the whole lists, of which ``merged`` may hold the leading rows only.
    """
    ids = corpus.select("folder", "Id")
    sizes = ids.groupBy("folder").agg(F.count(F.lit(1)).alias("n_docs"))
    weights = queries.select("qid", semantic_weight(query_len(F.col("query"))).alias("length_weight"))
    per_query = queries.count() * len(FOLDERS) * 4 * ROW_BYTES
    stats = attach(bounds, sizes, ["folder"], ["qid"], size=len(FOLDERS) * ROW_BYTES)
    stats = attach(stats, weights, ["qid"], ["folder"], size=per_query)
    stats = _filled(_filled(stats, "sem"), "kw").withColumn(
        "w",
        F.when((F.col("sem_n") > 0) & (F.col("kw_n") > 0), F.col("length_weight"))
        .when(F.col("sem_n") > 0, 1.0)
        .otherwise(0.0),
    )
    positive = (F.coalesce("sem_low", F.lit(1.0)) > 0) & (F.coalesce("kw_low", F.lit(1.0)) > 0)
    hits = F.greatest("sem_n", "kw_n")
    incomplete = hits < F.col("n_docs")
    short = incomplete & positive & (hits < n) if n is not None else F.lit(False)
    deep = incomplete if n is None else incomplete & ~positive
    rest_score = blend(F.col("sem_zero"), F.col("kw_zero")).alias("rest")
    stats = stored(stats.select("*", rest_score, short.alias("short"), deep.alias("deep")), "bounds")

    scored = attach(merged, stats, KEYS, ["Id"], "inner", per_query).select(
        *KEYS, "Id", blend(filled_value("sem"), filled_value("kw")).alias("score")
    )
    facts = stats.agg(F.max("short"), F.max("deep")).first()
    if not hits_only:
        seen = merged.select(*KEYS, "Id")
        if facts[0]:
            lowest = top_n(ids, ["folder"], 3 * n, [F.col("Id").asc()]).drop("rank")
            scored = scored.unionByName(_rest(stats.filter("short"), lowest, seen, per_query))
        if facts[1]:
            deep_ones = stats.filter("deep")
            rest = _all_unscored(deep_ones, ids, seen, per_query) if n is None else _lowest_unscored(deep_ones, ids, seen, n, per_query)
            scored = scored.unionByName(rest)
    return scored, stats


def filled_value(part: str, score: Column | None = None) -> Column:
    """The scaled value of a score of ``part``; an absent mail has 0."""
    score = F.coalesce(F.col(part) if score is None else score, F.lit(0.0))
    return F.when(F.col(f"{part}_n") > 0, scaled(score, F.col(f"{part}_lo"), F.col(f"{part}_hi"))).otherwise(0.0)


def blend(sem: Column, kw: Column) -> Column:
    return F.col("w") * sem + (1.0 - F.col("w")) * kw


def _rest(stats: DataFrame, mails: DataFrame, seen: DataFrame, size: int) -> DataFrame:
    """``mails`` that the queries of ``stats`` have not scored, with their common score.

    With positive scores unscored mails rank last, in id order: a query with fewer than n
    hits needs at most the ``3 n`` lowest ids of its folder.
    """
    wanted = stats.select(*KEYS, F.col("rest").alias("score"))
    pairs = attach(mails, wanted, ["folder"], ["Id"], "inner", size)
    return pairs.join(seen, [*KEYS, "Id"], "left_anti").select(*KEYS, "Id", "score")


def _all_unscored(stats: DataFrame, ids: DataFrame, seen: DataFrame, size: int) -> DataFrame:
    """All mails that a query of ``stats`` has not scored, with their common score, for a full ranking.

    The queries of a folder are numbered, and those that scored a mail become the bits of a few
    numbers. These are joined to the mail, and its missing pairs follow from them in place: no pair of
    a query and a mail is shuffled.
    """
    wanted = stats.select(*KEYS, F.col("rest").alias("score"))
    numbered = stored(rank_within(wanted, ["folder"], [F.col("qid").asc()], "_no", size // ROW_BYTES), "query_numbers")
    bit = F.pmod("_no", F.lit(BITS)).cast("int")
    numbered = numbered.select("*", F.floor(F.col("_no") / BITS).alias("_word"), bit.alias("_bit"))
    met = attach(seen, numbered.select(*KEYS, "_word", "_bit"), KEYS, ["Id"], "inner", size)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    masks = met.groupBy("folder", "Id", "_word").agg(F.bit_or(one).alias("_mask"))
    lists = numbered.groupBy("folder", "_word").agg(F.collect_list(F.struct("qid", "score", "_bit")).alias("_queries"))
    mails = attach(ids, lists.select("folder", "_word"), ["folder"], ["Id"], "inner", size)
    masked = attach(mails.join(masks, ["folder", "Id", "_word"], "left"), lists, ["folder", "_word"], ["Id"], "inner", size)
    mask = F.coalesce("_mask", F.lit(0).cast("bigint"))
    missing = F.filter("_queries", lambda q: F.getbit(mask, q["_bit"]) == 0)
    return masked.select("folder", "Id", F.explode(missing).alias("q")).select("folder", "q.qid", "Id", "q.score")


def _lowest_unscored(stats: DataFrame, ids: DataFrame, seen: DataFrame, n: int, size: int) -> DataFrame:
    """The ``n`` lowest ids of a folder that a query of ``stats`` has not scored, with their common
    score, by rank selection: no query meets the mails.

    Mails are numbered by id. A scored mail of number p that is the j-th scored one (from 1) has
    p - j unscored mails before it, so the i-th unscored mail has the number i plus the scored
    mails that have fewer than i unscored ones before them. Those are counted.
    """
    numbered = stored(number_docs(ids.select("folder", "Id").distinct()), "numbered")
    mine = attach(seen, stats.select(*KEYS), KEYS, ["Id"], "left_semi", size)
    placed = mine.join(numbered, ["folder", "Id"]).select(*KEYS, "doc_no")
    placed = rank_within(placed, KEYS, [F.col("doc_no").asc()], "earlier")
    gaps = placed.select(*KEYS, (F.col("doc_no") - 1 - F.col("earlier")).alias("gaps"))
    skipped = gaps.filter(F.col("gaps") < n).groupBy(*KEYS, "gaps").agg(F.count(F.lit(1)).alias("skipped"))
    each = stats.select(*KEYS, "rest", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("gaps"))
    # At most n rows a query on either side.
    up_to = Window.partitionBy(*KEYS).orderBy("gaps").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.col("gaps") + 1 + F.sum(F.coalesce("skipped", F.lit(0))).over(up_to)
    wanted = each.join(skipped, [*KEYS, "gaps"], "left").select(*KEYS, "rest", number.cast("bigint").alias("doc_no"))
    found = attach(numbered, wanted, ["folder", "doc_no"], ["Id"], "inner", n * size)
    return found.select(*KEYS, "Id", F.col("rest").alias("score"))
