"""Writers. Tasks write their own files; nothing passes through the driver."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.operators.tables import hash_bucket


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_quotes(quotes: DataFrame, path: str) -> None:
    """Append (name, price) rows with the current time."""
    stamped = quotes.select("name", "price", F.current_timestamp().alias("scraped_at"))
    stamped.write.mode("append").csv(path)


def write_vectors(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_vocab_text(vocab: DataFrame, path: str, token: str = "token") -> None:
    """One entry per line."""
    vocab.select(F.col(token).alias("value")).write.mode("overwrite").text(path)


def article_name(topic, link=None):
    """File-safe name of a topic's article, or of an article it links to."""
    main = tx.sanitize_name(topic)
    if link is None:
        return F.concat(F.lit("--"), main, F.lit("--"))
    return F.concat(main, F.lit("_"), tx.sanitize_name(link, keep_spaces=False))


def write_articles(articles: DataFrame, path: str, buckets: int = 64) -> None:
    """(title, content) as Parquet in ``buckets`` folders keyed by the safe name.

    A file per article would leave millions of small files. Rows of a bucket
    keep several writers, so a large bucket is not one task.
    """
    named = articles.withColumn("name", article_name(F.col("title")))
    placed = named.withColumn("bucket", hash_bucket(F.col("name"), buckets))
    placed.write.mode("append").partitionBy("bucket").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
