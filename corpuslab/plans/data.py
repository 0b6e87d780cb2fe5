"""Test tables in the roles the queries need (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.functions import vectors as vx
from corpuslab.operators import ordering, postings, stats, tokens, web
from corpuslab.session import bucketed, spread
from corpuslab.sources.readers import read_table


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return spread(read_table(spark, sf, "documents").select(*(columns or ("doc_id", "text"))), "doc_id")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read_table(spark, sf, "pages"), "page_id")


def clean(spark: SparkSession, sf: str, **options) -> DataFrame:
    return tokens.clean_sentences(documents(spark, sf), **options)


def words(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned words of every document."""
    return tokens.document_words(documents(spark, sf))


def bags(spark: SparkSession, sf: str) -> DataFrame:
    """Bags of the cleaned words of every document, written once in buckets of documents.

    Later steps read the bags, not the texts, and find the words of a document
    in one place.
    """
    return bucketed(postings.bags(words(spark, sf)), "doc_id")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "embeddings")
    return rows.select("vec_id", vx.as_doubles(F.col("embedding")).alias("vector"), "label")


def word_vectors(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """(word, vec_id, vector): the word of rank r in the corpus gets vector r."""
    freq = stats.doc_frequency(rows if rows is not None else words(spark, sf))
    ranked = ordering.dense_index(freq, [F.desc("df"), "word"], "vec_id")
    return ranked.join(embeddings(spark, sf), "vec_id").select("word", "vec_id", "vector")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled messages: raw label 0 or 4 for good rows, another value otherwise."""
    labels = read_table(spark, sf, "labels")
    raw = F.when(
        F.col("quality").isNotNull(),
        F.when(F.col("quality") == 1, F.col("toxic") * 4).otherwise(2),
    )
    return documents(spark, sf).join(labels, "doc_id", "left").withColumn("sentiment", raw)


def utterances(spark: SparkSession, sf: str) -> DataFrame:
    """User turns as queries; one id per (conversation, turn)."""
    rows = read_table(spark, sf, "conversations").filter(F.col("role") == "user")
    return spread(
        rows.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text"), "query_id"
    )


def page_titles(spark: SparkSession, sf: str) -> DataFrame:
    return web.page_quotes(pages(spark, sf)).select("page_id", "url", F.coalesce("title", F.lit("")).alias("title"))
