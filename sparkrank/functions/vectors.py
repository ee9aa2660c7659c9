"""Column expressions over ``array<float>`` vectors, summed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(
        F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    )


def l2_normalize(v: Column, zero: str = "null") -> Column:
    """Unit vector. A zero vector becomes nulls, or stays zero with ``zero='keep'``."""
    norm = F.nullif(l2_norm(v), F.lit(0.0))
    if zero == "keep":
        norm = F.coalesce(norm, F.lit(1.0))
    return F.get(
        F.transform(F.array(norm), lambda n: F.transform(v, lambda x: x.cast("double") / n)),
        F.lit(0),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null, not NaN, when either vector has no direction.

    NaN would sort before every number in a descending sort.
    """
    return dot(a, b) / F.nullif(l2_norm(a) * l2_norm(b), F.lit(0.0))
