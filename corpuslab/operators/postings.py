"""Bags of words as a stored table: each document's distinct words with their counts, in the document's own row.

A bag is made where the text is read, so nothing but the bag moves or is read
again: counts, frequencies, weights and document vectors all start from it. A
store grows by appending the bags of new documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.operators.unnest import each_struct

BAG = "bag"


def bags(rows: DataFrame, key: str = "doc_id", words: str = "words") -> DataFrame:
    """(key, bag): ``words`` sorted and each run of equal ones counted, inside the row; null words give no words."""
    placed = rows.select(key, F.sort_array(F.coalesce(words, F.array().cast("array<string>"))).alias("_sorted"))
    word, n = F.col("_sorted"), F.size("_sorted")
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    first = F.filter(every, lambda i: (i == 0) | (F.get(word, i) != F.get(word, i - 1)))
    begun = placed.withColumn("_first", first)
    counted = F.transform(
        "_first",
        lambda i, j: F.struct(
            F.get(word, i).alias("word"),
            (F.coalesce(F.get(F.col("_first"), j + 1), n) - i).cast("bigint").alias("n"),
        ),
    )
    return begun.select(key, counted.alias(BAG))


def write(bagged: DataFrame, path: str) -> None:
    """A new store, or more documents for one that is there."""
    bagged.write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def is_bagged(rows: DataFrame) -> bool:
    return BAG in rows.columns


def entries(bagged: DataFrame, *keep: Column | str) -> DataFrame:
    """``keep`` columns, word and n: a row for each word of each bag."""
    return each_struct(bagged, BAG, "word", *keep)
