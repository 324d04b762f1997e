"""Encoders: user models run in Arrow batches, and the built-in hashed bag of words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.functions.text import QUERY_TASK, query_prompt, tokens
from mailweave.functions.vectors import hash_encode

Encoder = Callable[[list[str]], np.ndarray]
CELLS = 1_000_000  # vector components of the built-in encoder summed at once, of one text at least
WORDS = 1_000_000  # words summed at once, of one text at least


def embed(
    df: DataFrame,
    text_col: str,
    encoder: Callable[[], Encoder] | None = None,
    batch_size: int = 32,
    dim: int = 64,
) -> DataFrame:
    """Replace ``text_col`` by a unit-length ``embedding array<float>``.

    ``encoder`` is a factory called once per task, so a model loads there and not per
    batch. Without one the built-in encoder is used: the vectors of :func:`hash_encode`, but
    each word is hashed once for many texts.
    """
    kept = [c for c in df.columns if c != text_col]
    fields = [f for f in df.schema.fields if f.name != text_col]
    vector = T.StructField("embedding", T.ArrayType(T.FloatType()))
    if encoder is None:
        words = df.select(*kept, tokens(F.col(text_col)).alias("_words"))
        return words.mapInArrow(_hashed(kept, dim), T.StructType([*fields, vector]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder()
        for whole in batches:
            for start in range(0, whole.num_rows, batch_size):
                batch = whole.slice(start, batch_size)
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                vectors = np.asarray(model(texts), dtype=np.float64)
                norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                unit = (vectors / np.maximum(norms, 1e-12)).astype(np.float32)
                columns = [batch.column(c) for c in kept]
                columns.append(pa.array(list(unit), type=pa.list_(pa.float32())))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "embedding"])

    return df.select(*kept, text_col).mapInArrow(encode, T.StructType([*fields, vector]))


def _hashed(kept: list[str], dim: int, cells: int = CELLS, most: int = WORDS) -> Callable:
    """Task of the built-in encoder: word lists to vectors."""

    def vectors(words: pa.Array, sizes: np.ndarray) -> pa.Array:
        n, found = len(words), words.flatten().dictionary_encode()
        buckets = [int(md5(w.encode()).hexdigest()[:8], 16) % dim for w in found.dictionary.to_numpy(zero_copy_only=False)]
        at = np.repeat(np.arange(n) * dim, sizes) + np.array(buckets, dtype=np.int64)[found.indices.to_numpy()]
        counts = np.bincount(at, minlength=n * dim).reshape(n, dim).astype(np.float64)
        # Sums of squared counts are whole numbers, so their order does not matter.
        norms = np.maximum(np.sqrt((counts * counts).sum(axis=1, keepdims=True)), 1e-12)
        values = pa.array((counts / norms).astype(np.float32).ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * dim, pa.int32()), values)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("_words")).to_numpy(zero_copy_only=False)
            ends, start = np.cumsum(sizes, dtype=np.int64), 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = min(int(np.searchsorted(ends, before + most, side="right")), start + cells // dim)
                part = batch.slice(start, max(stop, start + 1) - start)
                made = vectors(part.column("_words"), sizes[start : start + part.num_rows])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), made], names=[*kept, "embedding"])
                start += part.num_rows

    return encode


def embed_queries(
    variants: DataFrame,
    encoder: Callable[[], Encoder] | None = None,
    task: str | None = QUERY_TASK,
    batch_size: int = 32,
    dim: int = 64,
) -> DataFrame:
    """``(qid, variant_no, embedding)``. A model sees each variant inside the task prompt;
    the built-in encoder has no notion of a prompt and sees the variant alone. It is a native
    expression here, as queries are short.
    """
    if encoder is None:
        return variants.select("qid", "variant_no", hash_encode(F.col("variant"), dim).alias("embedding"))
    text = F.col("variant") if task is None else query_prompt(F.col("variant"), task)
    return embed(
        variants.select("qid", "variant_no", text.alias("text")), "text", encoder, batch_size, dim
    )
