"""Dot product, norm and cosine over array<double> columns, JVM-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def as_double_vector(c: Column) -> Column:
    return c.cast("array<double>")


def dot(u: Column, v: Column, rank: int | None = None) -> Column:
    """Sum of products in index order.

    With a known ``rank`` the sum is written out, so it stays inside generated code; the
    higher-order form for unknown lengths is interpreted.
    """
    if rank is not None:
        return reduce(lambda a, b: a + b, [u[i] * v[i] for i in range(rank)])
    return F.aggregate(F.zip_with(u, v, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(u: Column, v: Column) -> Column:
    """Cosine similarity; null when either vector is zero."""
    return dot(u, v) / F.nullif(norm(u) * norm(v), F.lit(0.0))
