"""Fill-in-the-middle transformation of documents, with memoized content-defined chunks.

A text is cut into lines at two random places; prefix, middle and suffix are put in the order in
which a model is to see them (prefix, suffix, middle, or suffix, prefix, middle), each behind its
mark. To find the places, a rolling hash cuts the bytes of a text into chunks where the content
says so, and a chunk is summed up once: its line ends, its code points, whether it holds a mark,
and its outermost bytes, by which a mark over the border of two chunks is seen. Summaries are kept
by content (a dictionary looks up the hash and then compares the bytes), so passages that many
documents share are read once per task. The counts of the chunks added up locate the chunk of a
cut, the line ends inside it the byte.

Rows are handled within their partition, nothing is shuffled. A task remembers at most
``memory`` bytes of chunks, the least recently used go first; that decides only what is counted
again. The hash is taken over blocks of ``BLOCK`` bytes, whatever the length of a text.

Edge cases: a null or empty text gives the plain form and the empty text. A text that holds a mark
stays plain, so that the output can always be taken apart. A null id draws as the empty string
does. Repeated rows are handled each, rows with one id draw alike. Extra columns are kept; columns
named as the added ones are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm.common import table

SEED = "7"
RATE = 100  # per cent of the texts that are transformed
SPM_RATE = 50  # per cent of these with the suffix first
# The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

WINDOW = 32
LEAST, MEAN_BITS, MOST = 256, 10, 8192
BLOCK = 1 << 17
MEMORY = 32 << 20
GEAR = np.random.default_rng(WINDOW).integers(0, 1 << 32, 256, dtype=np.uint32)
CONTINUATION = bytes(range(0x80, 0xC0))

ADDED = T.StructType(
    [
        T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


class Summary(NamedTuple):
    """What is known of a chunk: ``ends`` are the places behind its line ends."""

    ends: np.ndarray
    chars: int
    marked: bool
    head: bytes
    tail: bytes


def code_points(part: bytes) -> int:
    return len(part.translate(None, CONTINUATION))


def has_mark(part: bytes) -> bool:
    return PREFIX in part or SUFFIX in part or MIDDLE in part


def summarize(chunk: bytes) -> Summary:
    ends = np.flatnonzero(np.frombuffer(chunk, np.uint8) == 10) + 1
    return Summary(ends, code_points(chunk), has_mark(chunk), chunk[:2], chunk[-2:])


class Memo:
    """Summaries of the chunks seen, by content."""

    def __init__(self, memory: int = MEMORY) -> None:
        self.memory, self.held = memory, 0
        self.known: OrderedDict[bytes, Summary] = OrderedDict()
        self.hits = self.misses = 0

    def summary(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            self.known.move_to_end(chunk)
            return found
        self.misses += 1
        found = self.known[chunk] = summarize(chunk)
        self.held += len(chunk) + found.ends.nbytes + 400
        while self.held > self.memory and len(self.known) > 1:
            old, gone = self.known.popitem(last=False)
            self.held -= len(old) + gone.ends.nbytes + 400
        return found


def marked_places(data: np.ndarray) -> np.ndarray:
    """Places behind which the rolling hash of the ``WINDOW`` bytes before them asks for a cut."""
    found = []
    for start in range(0, len(data), BLOCK):
        first = max(0, start - WINDOW + 1)
        h = GEAR[data[first : start + BLOCK]]
        # The hash of 2w bytes is that of the last w and, shifted by w, that of the w before.
        w = 1
        while w < WINDOW:
            h[w:] += h[:-w] << np.uint32(w)
            w *= 2
        places = np.flatnonzero(h < np.uint32(1 << (32 - MEAN_BITS))) + first + 1
        found.append(places[places > start])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_ends(places: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of the text from ``start`` to ``end``. A chunk has ``LEAST`` bytes at
    least, so the window of each cut lies inside it; only the last one may be shorter."""
    out, at = [], start
    for place in [*places, end]:
        while place - at > MOST:
            at += MOST
            out.append(at)
        if place - at >= LEAST and place < end:
            out.append(place)
            at = place
    if at < end:
        out.append(end)
    return out


class Lines:
    """The lines of one text, counted from the summaries of its chunks."""

    def __init__(self, view: memoryview, start: int, end: int, cuts: list[int], memo: Memo) -> None:
        self.view, self.start, self.end = view, start, end
        self.at, self.parts, self.lines, self.chars = [start], [], [0], [0]
        self.marked, before = False, b""
        for cut in cuts:
            one = memo.summary(bytes(view[self.at[-1] : cut]))
            self.marked = self.marked or one.marked or has_mark(before + one.head)
            before = (before + one.tail)[-2:]
            self.parts.append(one)
            self.at.append(cut)
            self.lines.append(self.lines[-1] + len(one.ends))
            self.chars.append(self.chars[-1] + one.chars)
        # What follows the last line end is a line, too.
        self.count = self.lines[-1] + (end > start and before[-1:] != b"\n")

    def behind(self, k: int) -> tuple[int, int]:
        """Byte place and code points behind the first ``k`` lines."""
        if k == 0:
            return self.start, 0
        if k > self.lines[-1]:
            return self.end, self.chars[-1]
        chunk = bisect_left(self.lines, k) - 1
        offset = int(self.parts[chunk].ends[k - self.lines[chunk] - 1])
        at = self.at[chunk]
        return at + offset, self.chars[chunk] + code_points(bytes(self.view[at : at + offset]))


def draw(seed: str, key: object) -> tuple[int, ...]:
    """Four numbers below 2 ** 32 from the seed and the id."""
    own = f"{seed}:{'' if key is None else key}".encode()
    return struct.unpack(">4I", hashlib.sha256(own).digest()[:16])


def transform(lines: Lines, drawn: tuple[int, ...], rate: int, spm_rate: int) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    n, view = lines.count, lines.view
    if n == 0 or lines.marked or drawn[2] % 100 >= rate:
        return n, "plain", None, None, bytes(view[lines.start : lines.end])
    low, high = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
    (a, before), (b, upto) = lines.behind(low), lines.behind(high)
    prefix, middle, suffix = view[lines.start : a], view[a:b], view[b : lines.end]
    if drawn[3] % 100 < spm_rate:
        form, order = "spm", [SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle]
    else:
        form, order = "psm", [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle]
    return n, form, before, upto - before, b"".join(order)


def transform_batch(texts: pa.Array, keys: list, memo: Memo, seed: str, rate: int, spm_rate: int) -> list[tuple]:
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].tolist() if offsets else [0] * (len(texts) + 1)
    view = memoryview(data if data is not None else b"").cast("B")
    # Hash the bytes of these rows only.
    places = marked_places(np.frombuffer(view, np.uint8)[at[0] : at[-1]]) + at[0]
    bounds = np.searchsorted(places, at).tolist()
    places, out = places.tolist(), []
    for k, key in enumerate(keys):
        start, end = at[k], at[k + 1]
        cuts = chunk_ends(places[bounds[k] : bounds[k + 1]], start, end)
        out.append(transform(Lines(view, start, end, cuts, memo), draw(seed, key), rate, spm_rate))
    return out


def fill_in_middle(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: str = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    memory: int = MEMORY,
) -> DataFrame:
    """All columns of ``df`` and ``n, form, prefix_chars, middle_chars, output``."""
    names = {f.name for f in ADDED}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(memory)
        for batch in batches:
            keys = batch.column(key).to_pylist()
            done = transform_batch(batch.column(text), keys, memo, seed, rate, spm_rate)
            n, form, prefix, middle, output = zip(*done) if done else ((),) * 5
            made = [
                pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string()),
            ]
            columns = [*[batch.column(f.name) for f in kept], *made]
            yield pa.RecordBatch.from_arrays(columns, names=[*[f.name for f in kept], *[f.name for f in ADDED]])

    return df.mapInArrow(run, T.StructType([*kept, *ADDED.fields]))


def restored(output: Column, form: Column) -> Column:
    """The original text, from an output and its form alone."""
    parts = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
        .otherwise(output)
    )


def op11_fill_in_middle(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    again = restored(F.col("output"), F.col("form"))
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"),
    )


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
e AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (SELECT *, array_to_string(u[1:lo], '') AS p, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256 FROM g"""
