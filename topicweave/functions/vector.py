"""Vector expressions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the smallest length a vector is divided by.
MIN_NORM = 1e-12


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(v: Column) -> Column:
    return F.sqrt(
        F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def unit(v: Column) -> Column:
    """The vector at length one; a zero vector stays zero."""
    length = F.greatest(norm(v), F.lit(MIN_NORM))
    return F.transform(v, lambda x: x.cast("double") / length)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(MIN_NORM))
