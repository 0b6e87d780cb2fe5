"""Vocabularies, bags of words and TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuslab.operators import postings as bagged
from corpuslab.operators.ordering import SHORT_HEAD, dense_index, head
from corpuslab.operators.stats import word_frequencies
from corpuslab.operators.unnest import each
from corpuslab.session import cut_lineage, lookup


def document_count(rows: DataFrame) -> Column:
    return rows.agg(F.count("*")).scalar()


def vocabulary_bounds(
    rows: DataFrame,
    min_df: int = 1,
    max_share: float = 1.0,
    keep: int | None = None,
    by: str = "df",
    words: str = "words",
) -> DataFrame:
    """(word, cf, df) within document-frequency bounds, the ``keep`` strongest by ``by``."""
    return bound_vocabulary(
        word_frequencies(rows, words), document_count(rows), min_df, max_share, keep, by
    )


def bound_vocabulary(
    frequencies: DataFrame,
    n_docs: Column,
    min_df: int = 1,
    max_share: float = 1.0,
    keep: int | None = None,
    by: str = "df",
) -> DataFrame:
    """As above from a (word, cf, df) table that is already there."""
    bounded = frequencies.filter((F.col("df") >= min_df) & (F.col("df") <= max_share * n_docs))
    if keep is None:
        return bounded
    if keep > SHORT_HEAD:
        bounded = cut_lineage(bounded)  # counted, bounded and sorted below
    return head(bounded, keep, F.desc(by), "word", leading=-F.col(by))


def word_ids(vocab: DataFrame, capped: bool) -> DataFrame:
    """Add ``word_id`` in alphabetical order.

    A vocabulary capped by ``keep`` is numbered by a plain window; an uncapped
    one by the distributed index.
    """
    if not capped:
        return dense_index(vocab, ["word"], "word_id")
    return vocab.withColumn("word_id", (F.row_number().over(W.orderBy("word")) - 1).cast("bigint"))


def postings(rows: DataFrame, key: str = "doc_id", words: str = "words") -> DataFrame:
    """(key, word, n) from word arrays, or from bags of documents that each stand in one row."""
    if bagged.is_bagged(rows):
        return bagged.entries(rows, key)
    return each(rows, words, "word", key).groupBy(key, "word").agg(F.count("*").alias("n"))


def bag_of_words(
    rows: DataFrame, vocab: DataFrame, key: str = "doc_id", words: str = "words"
) -> DataFrame:
    """(key, word_id, n); words outside the vocabulary are ignored."""
    counted = postings(rows, key, words)
    return counted.join(lookup(vocab.select("word", "word_id")), "word").select(key, "word_id", "n")


def id_to_word(bags: DataFrame, vocab: DataFrame, key: str = "doc_id") -> DataFrame:
    return bags.join(vocab.select("word_id", "word"), "word_id").select(key, "word_id", "word", "n")


def smooth_idf(vocab: DataFrame, n_docs: Column) -> DataFrame:
    """ln((1 + N) / (1 + df)) + 1"""
    return vocab.withColumn("idf", F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)


def log2_idf(vocab: DataFrame, n_docs: Column) -> DataFrame:
    """log2(N / df)"""
    return vocab.withColumn("idf", F.log2(n_docs / F.col("df")))


def weigh(rows: DataFrame, idf: DataFrame, key: str = "doc_id", words: str = "words") -> DataFrame:
    """(key, word, n, idf, weight) with each document's weights at unit length.

    Only idf values travel to the postings; the norm is a window over one
    document, which is never more than the words of one row.
    """
    table = lookup(idf.select("word", "idf"))
    raw = postings(rows, key, words).join(table, "word").withColumn("raw", F.col("n") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(key)))
    return raw.withColumn("weight", F.col("raw") / F.nullif(length, F.lit(0.0))).drop("raw")


def tf_idf_smooth(rows: DataFrame, key: str = "doc_id", words: str = "words", **bounds) -> DataFrame:
    vocab = vocabulary_bounds(rows, words=words, **bounds)
    return weigh(rows, smooth_idf(vocab, document_count(rows)), key, words)


def tf_idf_log2(rows: DataFrame, key: str = "doc_id", words: str = "words", **bounds) -> DataFrame:
    """As above with log2 idf; words in every document weigh nothing and are left out."""
    vocab = vocabulary_bounds(rows, words=words, **bounds)
    weighed = weigh(rows, log2_idf(vocab, document_count(rows)), key, words)
    return weighed.filter(F.col("weight") > 1e-12)
