"""Array columns to rows.

A plain ``explode`` lets the optimiser add a filter on the array's size below
it. When the array is a tokenising expression, that filter tokenises every
text a second time, and before any repartitioning. The outer form adds no
filter; the empty row it gives for an empty array is dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(rows: DataFrame, array: Column | str, name: str, *keep: Column | str) -> DataFrame:
    """``keep`` columns and one row per element."""
    return rows.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def each_at(rows: DataFrame, array: Column | str, pos: str, name: str, *keep: Column | str) -> DataFrame:
    """As ``each``, with the 0-based position."""
    placed = rows.select(*keep, F.posexplode_outer(array).alias(pos, name))
    return placed.filter(F.col(pos).isNotNull())


def each_struct(rows: DataFrame, array: Column | str, mark: str, *keep: Column | str) -> DataFrame:
    """``keep`` columns and the fields of each struct; ``mark`` is a field that is never null."""
    return rows.select(*keep, F.inline_outer(array)).filter(F.col(mark).isNotNull())
