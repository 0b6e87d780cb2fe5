"""Readers. Schemas are explicit, so no file is read twice to guess types."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.operators.unnest import each_struct

MESSAGE_SCHEMA = (
    "sentiment int, item_id bigint, tstamp string, sentiment_source string, "
    "sender string, sentiment_text string"
)
DOCUMENT_SCHEMA = "id string, text string, author string"
UNSEEN_SCHEMA = "id string, text string"
HEADLINE_SCHEMA = "publish_date int, headline_text string"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV with supplied names."""
    return spark.read.schema(MESSAGE_SCHEMA).option("header", False).csv(path)


def read_headlines(spark: SparkSession, path: str) -> DataFrame:
    """Headlines; lines with more or fewer fields than the header are skipped.

    Column pruning is off for this read: with it, a line is parsed only as far
    as the asked columns reach and a malformed one would pass.
    """
    rows = (
        spark.read.schema(HEADLINE_SCHEMA)
        .option("header", True)
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", False)
        .csv(path)
    )
    return rows.select("headline_text")


def read_documents(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Headed CSV; quoted text may span lines."""
    schema = DOCUMENT_SCHEMA if labelled else UNSEEN_SCHEMA
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("escape", '"').csv(path)
    )


def read_term_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, term, value) from a wide CSV whose first column is an id.

    The header is the vocabulary. Zero cells are left out.
    """
    wide = spark.read.option("header", True).csv(path)
    key, *terms = wide.columns
    cells = [F.struct(F.lit(t).alias("term"), F.col(f"`{t}`").cast("double").alias("value")) for t in terms]
    return each_struct(wide, F.array(*cells), "term", F.col(f"`{key}`").alias("doc_id")).filter("value != 0")


def read_utterances(spark: SparkSession, path: str, query: str = "Query", intent: str = "Intent") -> DataFrame:
    """Two columns of a headed CSV, or of Parquet when the path says so."""
    rows = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.option("header", True).csv(path)
    return rows.select(F.col(query).alias("query"), F.col(intent).alias("intent"))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("header", True).csv(path)
    return rows.select(
        F.col("`Working Concepts`").alias("topic"), F.col("Traverse_links").cast("boolean").alias("traverse")
    )


def read_text_tree(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of every .txt file below a folder."""
    return (
        spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt")
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    )


def read_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(path, line) of every file in a folder."""
    return spark.read.text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")
    )


def count_files(spark: SparkSession, folder: str) -> int:
    """Files below a folder, whatever their extension; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path").count()


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(word, vector) from lines of a word and its numbers."""
    parts = F.split(F.trim("value"), " ", 2)
    return spark.read.text(path).select(
        F.get(parts, 0).alias("word"),
        F.split(F.get(parts, 1), " +").cast("array<double>").alias("vector"),
    )


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_model(path: str, spark: SparkSession | None = None) -> Model:
    """A stored model of any kind: pipeline, topics, clusters, word vectors, classifier.

    The kind is read from what is stored.
    """
    return DefaultParamsReader.loadParamsInstance(path, spark or SparkSession.getActiveSession())


def literal_corpus(spark: SparkSession, texts: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    return spark.createDataFrame(list(enumerate(texts)), f"{key} bigint, {text} string")
