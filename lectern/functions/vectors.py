"""Array-as-vector column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x
    )


def l2_norm(vec: Column) -> Column:
    return F.sqrt(dot(vec, vec))


def l2_normalize(vec: Column) -> Column:
    """Unit-length copy. A zero vector stays as it is. The norm is bound once
    per row: written inside the inner lambda it would be summed per element."""
    per_norm = F.transform(
        F.array(l2_norm(vec)),
        lambda norm: F.transform(as_doubles(vec), lambda x: F.when(norm > 0, x / norm).otherwise(x)),
    )
    return per_norm[0]


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
