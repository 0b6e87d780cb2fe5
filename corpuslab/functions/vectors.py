"""Expressions over ``array<double>`` vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def vector_sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return vector_sum(F.zip_with(a, b, lambda x, y: x * y))


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector has no length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def cosine_distance(a: Column, b: Column) -> Column:
    return 1.0 - cosine(a, b)


def squares(vector: Column) -> Column:
    return F.transform(vector, lambda x: x * x)


def reciprocals(vector: Column) -> Column:
    """Diagonal of the inverse of a diagonal matrix; zero entries give null."""
    return F.transform(vector, lambda x: F.lit(1.0) / F.nullif(x, F.lit(0.0)))


def concat_arrays(*vectors: Column) -> Column:
    return F.concat(*vectors)


def slice_columns(vector: Column, start: int, length: int) -> Column:
    """``length`` entries from the 1-based position ``start``."""
    return F.slice(vector, start, length)


def binarize(vector: Column) -> Column:
    """1 for each positive entry; other entries stay as they are."""
    return F.transform(vector, lambda x: F.when(x > 0, F.lit(1.0)).otherwise(x))
