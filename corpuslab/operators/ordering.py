"""Global positions, caps and per-group ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuslab.session import cut_lineage, lookup

# monotonically_increasing_id keeps the position within a partition in its
# lower 33 bits.
_POSITION_MASK = (1 << 33) - 1

SHORT_HEAD = 10_000


def dense_index(df: DataFrame, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """Dense 0-based position of every row in the global order of ``order``.

    ``row_number`` over an unpartitioned window would bring all rows to one
    task. Here the rows are range-sorted, written once, counted per partition,
    and each row adds its partition's offset; only one number per partition
    leaves the executors. ``order`` must be total for a repeatable result.
    """
    placed = cut_lineage(df.orderBy(*order)).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(_POSITION_MASK).alias("_pos"),
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition of the sorted table.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos"))
        .drop("_part", "_pos", "_offset")
    )


def index_within(
    df: DataFrame, group: str, order: Sequence[Column | str], name: str = "idx"
) -> DataFrame:
    """Dense 0-based position within each value of ``group``.

    A group may hold most of the rows, so it is not given to one task: the
    global position is taken and the position of the group's first row is
    subtracted.
    """
    placed = dense_index(df, [group, *order], "_global")
    first = placed.groupBy(group).agg(F.min("_global").alias("_first"))
    return (
        placed.join(lookup(first), group)
        .withColumn(name, F.col("_global") - F.col("_first"))
        .drop("_global", "_first")
    )


def head(
    df: DataFrame, n: int, *order: Column | str, leading: Column | None = None
) -> DataFrame:
    """The first ``n`` rows in a total order, in that order.

    A short head is a top-n: each task keeps n rows. A long one would send n
    rows per task to a single task, so it is cut by distributed position
    instead. ``leading`` is a number that rises with the order; rows clearly
    past the n-th are then dropped before the sort by an approximate quantile,
    whose result is used only if it leaves at least n rows.
    """
    if n <= SHORT_HEAD:
        return df.orderBy(*order).limit(n)
    total = df.count()
    if total <= n:
        return df.orderBy(*order)
    if leading is not None:
        share = min(1.0, n / total + 0.001)
        bound = df.agg(F.percentile_approx(leading, share, 10_000)).first()[0]
        nearer = df.filter(leading.isNull() | (leading <= bound))
        if nearer.count() >= n:
            df = nearer
    return dense_index(df, order, "_at").filter(F.col("_at") < n).drop("_at")


def top_per_group(
    df: DataFrame, group: str | Sequence[str], n: int, *order: Column | str, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows of each group; rows past ``n`` are dropped before the shuffle.

    Spark places a group limit below the exchange for this shape, so a large
    group sends at most ``n`` rows per input partition.
    """
    keys = [group] if isinstance(group, str) else list(group)
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
