"""How filters interact: what each one removes in every order in which they could be applied.

Every document is judged once by all filters; its failures are the bits of one number. Counted by
part, the numbers fill a contingency tensor with an axis of two (pass, fail) per filter: the
documents, the good ones among them and the toxic ones. What a step of an order keeps or removes is
a contraction of that tensor: along each axis it selects pass (filters applied before), fail (the
filter of the step) or all (filters not yet applied). All orders and steps are one ``einsum``.

The work on documents is the judging and one aggregation by part and bits, with partial sums before
the shuffle: 2 ** filters rows a part at most. Exact duplicates are told by the sha256 of the text;
only digests that occur twice are joined back, broadcast if measured small, else with the digests
of many copies split. Nothing is gathered on the driver; a part's tensor has 32 cells, its result
600 rows, whatever its documents.

Edge cases: a null text counts as empty, and empty texts are copies of each other. A null part is
the part of the empty string. A null id is no copy of another and has no label; rows with the same
id and text are no copies of each other, as none has a smaller id. An id with several labels counts
as good if any of them says so, in the same way as toxic. Extra columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import table, words
from mailweave.operators.joins import attach
from mailweave.session import stored

FILTERS = "ABCDE"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def text_failures(text: Column) -> list[Column]:
    """Failures of the filters that read the text alone, A to D."""
    whole = F.coalesce(text, F.lit(""))
    found = words(text)
    n = F.size(found)
    return [
        n < 200,
        100 * F.size(F.array_distinct(found)).cast("bigint") < 50 * n.cast("bigint"),
        100 * F.regexp_count(whole, F.lit("[A-Z]")).cast("bigint") > 3 * F.length(whole).cast("bigint"),
        whole.rlike(r"[#$%&*|]"),
    ]


def bitmask(failures: list[Column], width: int = len(FILTERS)) -> Column:
    """One number of the failures; the first filter has the highest of ``width`` bits."""
    marks = [F.when(f, F.lit(1 << (width - 1 - k))).otherwise(0) for k, f in enumerate(failures)]
    return sum(marks[1:], marks[0])


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``(part, bits, good, toxic)`` of every document."""
    body = F.col(f"`{text}`")
    judged = stored(
        docs.select(
            F.col(f"`{key}`").alias("id"),
            F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
            bitmask(text_failures(body)).alias("bits"),
            F.unhex(F.sha2(F.coalesce(body, F.lit("")), 256)).alias("digest"),
        ),
        "judged",
    )
    copied = judged.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    copied = stored(copied.filter("n > 1").select("digest", "first"), "copied")
    marked = labels.select(
        F.col(f"`{key}`").alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")
    )
    marked = stored(
        marked.filter("id IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")), "marked"
    )
    rows = attach(judged, copied, ["digest"], ["id"])
    rows = attach(rows, marked, ["id"], ["digest"])
    no = F.lit(False)
    return rows.select(
        "part",
        (F.col("bits") + F.when(F.col("id") > F.col("first"), 1).otherwise(0)).alias("bits"),
        F.coalesce("good", no).alias("good"),
        F.coalesce("toxic", no).alias("toxic"),
    )


def contingency(rows: DataFrame) -> DataFrame:
    """``(part, cells)``: documents, good ones and toxic ones for each number of bits that occurs."""
    counts = rows.groupBy("part", "bits").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("bigint")).alias("good"), F.sum(F.col("toxic").cast("bigint")).alias("toxic")
    )
    return counts.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("cells"))


def orders(filters: str = FILTERS) -> list[str]:
    return ["".join(p) for p in permutations(filters)]


def selectors(filters: str = FILTERS) -> dict[str, np.ndarray]:
    """For each measure and every step of every order, what is selected along each axis."""
    chosen: dict[str, list] = {"kept": [], "removed": [], "failing": [], "unique_fails": []}
    for order in orders(filters):
        for step, own in enumerate(order):
            before, upto = order[:step], order[: step + 1]
            chosen["kept"].append([PASS if f in upto else ALL for f in filters])
            chosen["removed"].append([FAIL if f == own else PASS if f in before else ALL for f in filters])
            chosen["failing"].append([FAIL if f == own else ALL for f in filters])
            chosen["unique_fails"].append([FAIL if f == own else PASS for f in filters])
    return {name: np.array(rows, dtype=np.int64) for name, rows in chosen.items()}


def contract(tensor: np.ndarray, selector: np.ndarray) -> np.ndarray:
    """``tensor[part, axis, axis, ...]`` and ``selector[step, axis, 2]`` -> ``[part, step]``."""
    axes = "abcdefgh"[: selector.shape[1]]
    formula = f"p{axes},{','.join('s' + a for a in axes)}->ps"
    return np.einsum(formula, tensor, *np.moveaxis(selector, 1, 0), optimize=True)


def interactions(tensors: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """The measures ``[part, step]`` from ``tensors[3, part, 2, 2, ...]``: all, good, toxic."""
    by = selectors(filters)
    own = np.array([f for order in orders(filters) for f in order])
    out = {name: contract(tensors[0], by[name]) for name in ("kept", "removed", "unique_fails")}
    out["redundant"] = contract(tensors[0], by["failing"]) - out["removed"]
    out["good_lost"] = contract(tensors[1], by["removed"])
    out["toxic_lost"] = contract(tensors[2], by["removed"])
    out["shapley"] = np.zeros_like(out["removed"])
    for f in filters:
        out["shapley"][:, own == f] = out["removed"][:, own == f].sum(axis=1, keepdims=True)
    return out


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``rows(part, bits, good, toxic)`` -> a row per part, order and step."""
    names, steps = orders(filters), len(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                flat = np.zeros((3, batch.num_rows, 1 << steps), dtype=np.int64)
                for p, cells in enumerate(batch.column("cells").to_pylist()):
                    for c in cells:
                        flat[:, p, c["bits"]] = c["n"], c["good"], c["toxic"]
                found = interactions(flat.reshape(3, batch.num_rows, *[2] * steps), filters)
                rows_each = len(names) * steps
                parts = batch.column("part").take(pa.array(np.repeat(np.arange(batch.num_rows), rows_each)))
                order_names = pa.array(np.repeat(names, steps).tolist() * batch.num_rows, pa.string())
                step_numbers = pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(names) * batch.num_rows))
                columns = [parts, order_names, step_numbers, *[pa.array(found[m].reshape(-1)) for m in MEASURES]]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *MEASURES])

    schema = "part string, filter_order string, step int, " + ", ".join(f"{m} bigint" for m in MEASURES)
    return contingency(rows).mapInArrow(run, schema)


def op12_filter_audit(spark, sf_dir) -> DataFrame:
    return audit(judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
j AS (SELECT doc_id, part, len(l) < 200 AS a, 100 * len(list_distinct(l)) < 50 * len(l) AS b,
  100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM w),
m AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
h AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM j LEFT JOIN m USING (doc_id) GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM f p JOIN f q ON q.f <> p.f JOIN f r ON r.f NOT IN (p.f, q.f)
  JOIN f s ON s.f NOT IN (p.f, q.f, r.f) JOIN f t ON t.f NOT IN (p.f, q.f, r.f, s.f)),
g AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
x AS (SELECT h.*, g.*, CASE own WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
  (a AND contains(before, 'A')) OR (b AND contains(before, 'B')) OR (c AND contains(before, 'C')) OR (d AND contains(before, 'D'))
  OR (e AND contains(before, 'E')) AS gone,
  CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS n_fails FROM h, g),
y AS (SELECT part, filter_order, step, own, CAST(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed, CAST(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost FROM x GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM y"""
