"""Vector and weight expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailweave.functions.text import bucket_counts, let


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision, summed in array order."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalize(col: Column) -> Column:
    """Unit-length ``array<float>``; a zero vector stays zero."""
    norm = F.greatest(F.sqrt(dot(col, col)), F.lit(1e-12))
    return let(
        norm, lambda n: F.transform(col, lambda x: (x.cast("double") / n).cast("float"))
    )


def hash_encode(col: Column, dim: int = 64) -> Column:
    """Deterministic text vector: hashed bag of words of unit length, without a model."""
    return let(bucket_counts(col, dim), l2_normalize)


def semantic_weight(length: Column) -> Column:
    """Weight of the vector ranking as a logistic function of the query length."""
    growth = 1.0 / (1.0 + F.exp(-0.9 * (length - 4)))
    return F.least(F.lit(0.75), 0.25 + 0.5 * (growth - 1.0 / (1.0 + F.exp(F.lit(2.7)))))


def rank_decay(rank: Column, decay: float = 20.0) -> Column:
    """Exponential weight of a 0-based rank."""
    return F.exp(-rank / F.lit(decay))
