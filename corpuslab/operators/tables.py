"""Row and column selection, recoding, splitting and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.operators.ordering import dense_index, index_within
from corpuslab.session import lookup


def select_columns(
    df: DataFrame, keep: Sequence[str], rename: Mapping[str, str] | None = None
) -> DataFrame:
    renames = rename or {}
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in keep])


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def recode(column: Column, mapping: Mapping[int, int]) -> Column:
    """Mapped value; null for any value the mapping does not name."""
    chain = None
    for old, new in mapping.items():
        chain = F.when(column == old, F.lit(new)) if chain is None else chain.when(
            column == old, F.lit(new)
        )
    return chain


def usable_messages(df: DataFrame, text: str = "text", tokens: str = "tokens") -> DataFrame:
    """Tokenise messages; rows whose text cannot be tokenised are left out."""
    return df.withColumn(tokens, tx.social_tokens(F.col(text))).filter(F.col(tokens).isNotNull())


def point_lookup(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The row at 0-based position ``n``."""
    return dense_index(df, order, "doc_idx").filter(F.col("doc_idx") == n)


def length_classes(df: DataFrame, text: str = "text", limits: tuple[int, int] = (5, 150)) -> DataFrame:
    """Word count of each text and the length predicates used for profiling."""
    short, long = limits
    n = F.size(tx.split_space(F.col(text)))
    return df.withColumn("n_words", n).withColumns(
        {
            "two_words": F.col("n_words") == 2,
            "three_words": F.col("n_words") == 3,
            "short": F.col("n_words") <= short,
            "ordinary": F.col("n_words") <= long,
            "long": F.col("n_words") > long,
        }
    )


def label_ids(df: DataFrame, label: str, name: str = "label_id") -> DataFrame:
    """(label, id) with ids in alphabetical order of the labels."""
    return dense_index(df.select(label).distinct(), [label], name)


def label_encode(df: DataFrame, label: str, name: str = "label_id") -> DataFrame:
    return df.join(lookup(label_ids(df, label, name)), label)


def hash_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a key that does not depend on how the rows are partitioned."""
    prefix = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(prefix, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def holdout_split(df: DataFrame, key: str, train_percent: int = 80) -> DataFrame:
    """Add ``split``: TRAIN or TEST, stable for a key."""
    part = F.when(hash_bucket(F.col(key), 100) < train_percent, "TRAIN").otherwise("TEST")
    return df.withColumn("split", part)


def tag_rows(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Add ``tag``: the split's name and the row's position within the split."""
    placed = index_within(df, split, [key], "_i")
    return placed.withColumn("tag", F.concat_ws("_", split, F.col("_i"))).drop("_i")


def paste_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Put two tables side by side by key instead of by position."""
    return left.join(right, key)


def zip_columns(first: Column, second: Column) -> Column:
    return F.arrays_zip(first, second)


def append_rows(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def difference(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return df.join(other, key, "left_anti")


def membership(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return df.join(other, key, "left_semi")
