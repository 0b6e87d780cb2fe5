from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.operators import similarity, vectors
from corpuslab.streaming import jobs


def test_quotes_stream_appends_each_page_once(spark, tmp_path):
    source, sink, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    page = '<h1 class="name"> SPX </h1><div class="price">10</div>'
    first = spark.createDataFrame([(1, "u", page)], jobs.PAGE_SCHEMA)
    first.write.parquet(source)
    jobs.stream_quotes(spark, source, sink, check).awaitTermination()
    spark.createDataFrame([(2, "u", page)], jobs.PAGE_SCHEMA).write.mode("append").parquet(source)
    jobs.stream_quotes(spark, source, sink, check).awaitTermination()
    rows = spark.read.parquet(sink).collect()
    assert [(r["name"], r["price"]) for r in rows] == [("SPX", "10")] * 2
    assert all(r["scraped_at"] for r in rows)


def test_intent_stream_scores_each_batch(spark, tmp_path):
    source, sink, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    table = spark.createDataFrame([("open", [1.0, 0.0]), ("close", [0.0, 1.0])], "word string, vector array<double>")
    labelled = spark.createDataFrame(
        [(10, [1.0, 0.1], "opening"), (11, [0.1, 1.0], "closing")], "stored_id long, vector array<double>, intent string"
    )

    def vectorize(batch):
        rows = batch.select("query_id", tx.clean_utterance(F.col("text")).alias("words"))
        return vectors.mean_word_vectors(rows, table, 2, "query_id")

    asked = spark.createDataFrame([(1, "please open it"), (2, "close it"), (3, "nothing known")], jobs.UTTERANCE_SCHEMA)
    asked.write.parquet(source)
    jobs.stream_intents(spark, source, sink, check, labelled, vectorize).awaitTermination()
    got = {r["query_id"]: r["intent"] for r in spark.read.parquet(sink).collect()}
    assert got == {1: "opening", 2: "closing"}


def test_labelled_side_is_prepared_once(spark, tmp_path, monkeypatch):
    """Batches read the index: the labelled rows are grouped once, before the stream, whatever the batches."""
    source, sink, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    labelled = spark.createDataFrame(
        [(10, [1.0, 0.1], "opening"), (11, [0.1, 1.0], "closing")], "stored_id long, vector array<double>, intent string"
    )
    grouped, made = [], similarity.distinct_vectors
    monkeypatch.setattr(similarity, "distinct_vectors", lambda *a: grouped.append(1) or made(*a))

    def vectorize(batch):
        return batch.select("query_id", F.array(F.lit(1.0), F.lit(0.0)).alias("vector"))

    for i in range(3):
        asked = spark.createDataFrame([(i, "x")], jobs.UTTERANCE_SCHEMA)
        asked.coalesce(1).write.mode("append").parquet(source)
    stored = str(tmp_path / "index")
    similarity.build_index(labelled).save(stored)
    index = similarity.open_index(spark, stored)
    stream = jobs.stream_intents(spark, source, sink, check, labelled, vectorize, index=index)
    stream.awaitTermination()
    assert {r["query_id"]: r["intent"] for r in spark.read.parquet(sink).collect()} == {i: "opening" for i in range(3)}
    assert grouped == [1]
