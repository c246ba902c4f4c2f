"""Expressions over ``array<float>`` vectors. Sums accumulate in double."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DIM = 16


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """v divided by its length; a zero vector is left as it is."""
    squares = F.transform(as_doubles(v), lambda x: x * x)
    # An argument of its own: inside the function of an element it would be computed for every element.
    divisor = F.aggregate(
        squares, F.lit(0.0), lambda s, x: s + x, lambda s: F.when(s == 0, 1.0).otherwise(F.sqrt(s))
    )
    return F.zip_with(as_doubles(v), F.array_repeat(divisor, F.size(v)), lambda x, by: x / by)


def zeros(dim: int = DIM) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def or_zeros(v: Column, dim: int = DIM) -> Column:
    return F.coalesce(v.cast("array<float>"), zeros(dim))


def blend(a: Column, b: Column, alpha: float) -> Column:
    """alpha * a + (1 - alpha) * b, element by element."""
    return F.zip_with(
        as_doubles(a), as_doubles(b), lambda x, y: x * alpha + y * (1.0 - alpha)
    ).cast("array<float>")
