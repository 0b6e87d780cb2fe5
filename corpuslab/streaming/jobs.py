"""Streaming jobs: pages in, quotes out; utterances in, intents out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuslab.operators.similarity import VectorIndex, best_intent, build_index
from corpuslab.operators.web import page_quotes
from corpuslab.session import cut_lineage

PAGE_SCHEMA = "page_id bigint, url string, html string"
UTTERANCE_SCHEMA = "query_id bigint, text string"


def stream_quotes(
    spark: SparkSession, source: str, sink: str, checkpoint: str, name_class: str | None = "name"
) -> StreamingQuery:
    """Append a timestamped quote row for each page file that arrives."""
    pages = spark.readStream.schema(PAGE_SCHEMA).parquet(source)
    quotes = page_quotes(pages, name_class).select(
        "name", "price", F.current_timestamp().alias("scraped_at")
    )
    return (
        quotes.writeStream.outputMode("append").format("parquet")
        .option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_intents(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    labelled: DataFrame,
    vectorize: Callable[[DataFrame], DataFrame],
    intent: str = "intent",
    index: VectorIndex | None = None,
) -> StreamingQuery:
    """Score each batch of utterances against a static labelled table.

    The labelled vectors are grouped, measured and indexed once, before the
    stream starts; ``index`` takes one that is there already (for instance
    ``open_index`` of a stored version). The best row is an aggregate within
    one utterance, so it is taken per batch and no state is kept. The batch
    number names the output folder, so a batch that runs again replaces its own
    rows.
    """
    ready = index or build_index(labelled)
    intents = cut_lineage(labelled.select("stored_id", intent))

    def score(batch: DataFrame, number: int) -> None:
        found = best_intent(ready.nearest(vectorize(batch)), intents, intent)
        found.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    utterances = spark.readStream.schema(UTTERANCE_SCHEMA).parquet(source)
    return (
        utterances.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
