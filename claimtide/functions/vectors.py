"""Vector similarity on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a, b, norm_a=None, norm_b=None) -> Column:
    """Cosine similarity; null when a vector is missing or zero."""
    length = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    return F.when(length > 0, dot(a, b) / length)
