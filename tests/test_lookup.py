from pyspark.sql import functions as F

from corpuslab import session
from corpuslab.operators import phrases, vectors


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_is_broadcast_only_below_the_limit(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", 10_000)
    big = spark.range(100_000).select(F.col("id").cast("string").alias("word"))
    few = spark.createDataFrame([("1", [0.5])], "word string, vector array<double>")
    many = big.withColumn("vector", F.array(F.lit(1.0)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(big.join(session.lookup(few), "word"))
        assert "BroadcastHashJoin" not in plan(big.join(session.lookup(many), "word"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shuffled_and_broadcast_lookups_agree(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(i, 0, ["hot", "cold", "hot", f"w{i % 5}", "hot"]) for i in range(60)],
        "doc_id long, sent_pos int, words array<string>",
    )
    accepted = spark.createDataFrame([("hot", "cold"), ("w1", "hot")], "first string, second string")
    table = spark.createDataFrame([("hot", [1.0, 0.0]), ("w1", [0.0, 1.0])], "word string, vector array<double>")
    results = []
    for limit in (1 << 20, -1):
        monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
        merged = phrases.merge_phrases(rows, accepted).orderBy("doc_id").collect()
        means = vectors.mean_word_vectors(rows, table, 2).orderBy("doc_id").collect()
        results.append((merged, means))
    assert results[0] == results[1]
