"""Profiles, counts and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.operators import postings
from corpuslab.operators.unnest import each, each_struct
from corpuslab.session import lookup


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def length_stats(df: DataFrame, text: str = "text") -> DataFrame:
    n = df.select(F.size(tx.split_space(F.col(text))).alias("n"))
    return n.agg(
        F.avg("n").alias("mean_words"),
        F.min("n").alias("min_words"),
        F.max("n").alias("max_words"),
    )


def length_counts(df: DataFrame, text: str = "text", long: int = 150, short: int = 5) -> DataFrame:
    n = df.select(F.size(tx.split_space(F.col(text))).alias("n"))
    return n.agg(
        F.count_if(F.col("n") > long).alias("n_long"),
        F.count_if(F.col("n") <= short).alias("n_short"),
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts over equal bins between the least and greatest value.

    The last bin is closed on the right. The bounds are a scalar subquery, so
    the values are read, reduced and never moved.
    """
    bounds = df.agg(
        F.struct(
            F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")
        ).alias("b")
    ).scalar()
    placed = df.select(F.col(column).cast("double").alias("x"), bounds.alias("b"))
    width = F.col("b.hi") - F.col("b.lo")
    position = F.when(
        width > 0,
        F.least(F.floor((F.col("x") - F.col("b.lo")) * bins / width), F.lit(bins - 1)),
    ).otherwise(F.lit(0))
    return placed.groupBy(position.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def word_counts(rows: DataFrame, words: str = "words") -> DataFrame:
    """(word, n) over the whole corpus; summed inside each task before moving."""
    return each(rows, words, "word").groupBy("word").agg(F.count("*").alias("n"))


def doc_frequency(rows: DataFrame, words: str = "words") -> DataFrame:
    """(word, df): each document's words are made distinct inside its own row (see ``postings`` for bags)."""
    if postings.is_bagged(rows):
        return postings.entries(rows).groupBy("word").agg(F.count("*").alias("df"))
    single = each(rows, F.array_distinct(words), "word")
    return single.groupBy("word").agg(F.count("*").alias("df"))


def word_frequencies(rows: DataFrame, words: str = "words") -> DataFrame:
    """(word, cf, df) with one shuffle of per-task sums."""
    if postings.is_bagged(rows):
        return postings.entries(rows).groupBy("word").agg(F.sum("n").alias("cf"), F.count("*").alias("df"))
    marked = F.concat(
        F.transform(words, lambda w: F.struct(w.alias("word"), F.lit(1).alias("c"), F.lit(0).alias("d"))),
        F.transform(
            F.array_distinct(words),
            lambda w: F.struct(w.alias("word"), F.lit(0).alias("c"), F.lit(1).alias("d")),
        ),
    )
    return (
        each_struct(rows, marked, "word")
        .groupBy("word")
        .agg(F.sum("c").alias("cf"), F.sum("d").alias("df"))
    )


def word_counts_by_author(words_by_author: DataFrame, top: DataFrame, author: str = "author") -> DataFrame:
    """(word, df, author, n, upto): counts of the ``top`` words for every author of the table, zeros included.

    ``words_by_author`` has (author, words), ``top`` (word, df) a few rows.
    ``upto`` adds up the authors in their order. Words outside ``top`` are
    dropped before anything moves.
    """
    single = each(words_by_author, "words", "word", author)
    counts = single.join(lookup(top.select("word")), "word").groupBy(author, "word").agg(F.count("*").alias("n"))
    # one small map for each author, over the words of top
    maps = counts.groupBy(author).agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("of"))
    listed = top.agg(F.sort_array(F.collect_list(F.struct("word", "df"))).alias("top")).scalar()
    every = words_by_author.select(author).distinct().join(maps, author, "left").withColumn("top", listed)
    rows = every.select(author, "of", F.inline("top")).select(
        "word", "df", author, F.coalesce(F.try_element_at("of", F.col("word")), F.lit(0)).alias("n")
    )
    return rows.withColumn("upto", F.sum("n").over(W.partitionBy("word").orderBy(author)))


def nonascii_words(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, word, n) for words that hold a non-ASCII character."""
    hits = F.filter(tx.split_space(F.col(text)), lambda w: w.rlike(tx.NON_ASCII))
    return (
        each(df, hits, "word", key)
        .groupBy(key, "word")
        .agg(F.count("*").alias("n"))
    )


def energy_rank(values: DataFrame, share: float = 0.85, value: str = "s") -> DataFrame:
    """Smallest rank whose squared values reach ``share`` of the total.

    ``values`` holds one row per singular value (``rank`` from 1), at most the
    number of kept factors.
    """
    energy = F.col(value) * F.col(value)
    running = F.sum(energy).over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, 0))
    total = values.agg(F.sum(energy)).scalar()
    return (
        values.withColumn("energy", running)
        .filter(F.col("energy") >= total * share)
        .agg(F.min("rank").alias("k"))
    )
