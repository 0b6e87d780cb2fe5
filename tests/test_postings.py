"""Bags of words against counts of the texts, a store that grows, and the lemma and spelling tables that feed from them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import lexical, postings, stats, tokens, vectors, weights
from corpuslab.plans import data, vectorising

ROWS = [(1, ["b", "a", "b", "é"]), (2, []), (3, None), (4, ["a"]), (5, ["x"] * 5000 + ["a"])]


def rows(spark):
    return spark.createDataFrame(ROWS, "doc_id long, words array<string>")


def test_bags_count_every_word(spark):
    got = {r.doc_id: {e.word: e.n for e in r.bag} for r in postings.bags(rows(spark)).collect()}
    assert got == {k: dict(Counter(w or [])) for k, w in ROWS}


def test_steps_on_bags_equal_steps_on_words(spark):
    arrays, bagged = rows(spark), postings.bags(rows(spark))
    table = spark.createDataFrame([("a", [1.0, 0.0]), ("x", [0.0, 3.0])], "word string, vector array<double>")

    def said(df):
        return sorted(map(str, df.select(*sorted(df.columns)).collect()))

    for step in (
        weights.postings, stats.doc_frequency, stats.word_frequencies, lambda r: weights.tf_idf_smooth(r),
        lambda r: vectors.mean_word_vectors(r, table, 2),
    ):
        assert said(step(arrays)) == said(step(bagged))


def test_a_store_grows(spark, tmp_path):
    path = str(tmp_path / "bags")
    postings.write(postings.bags(rows(spark)), path)
    more = spark.createDataFrame([(9, ["a", "new"])], "doc_id long, words array<string>")
    postings.write(postings.bags(more), path)
    found = {r.word: (r.cf, r.df) for r in stats.word_frequencies(postings.read(spark, path)).collect()}
    assert found == {"a": (4, 4), "b": (2, 1), "é": (1, 1), "x": (5000, 1), "new": (1, 1)}


@pytest.mark.parametrize("build", [vectorising.document_vectors, lambda spark, sf: weights.tf_idf_smooth(data.bags(spark, sf))])
def test_no_exchange_after_the_bags_are_placed(spark, build):
    """Neither text nor words move: sums and norms of a document find its words in place."""
    plan = build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    body = plan.split("Subquery")[0]
    assert "text" not in body and "Exchange hashpartitioning" not in body


def test_irregular_forms_go_ahead_of_the_rules(spark):
    words = spark.createDataFrame([(w,) for w in "mice wolves cars glasses went cats cat car wolf".split()], "word string")
    assert {r.word: r.lemma for r in lexical.lemma_table(words).collect()} == {
        "mice": "mouse", "wolves": "wolf", "cars": "car", "cats": "cat"
    }
    verbs = spark.createDataFrame([(w,) for w in "went is walked walk mice".split()], "word string")
    assert {r.word: r.lemma for r in lexical.lemma_table(verbs, part="verb").collect()} == {"went": "go", "is": "be", "walked": "walk"}
    own = spark.createDataFrame([("wibbles", "wobble")], "word string, lemma string")
    given = spark.createDataFrame([("wibbles",), ("mice",)], "word string")
    assert {r.word: r.lemma for r in lexical.lemma_table(given, irregular=own).collect()} == {"wibbles": "wobble"}


def test_no_word_above_the_floor_is_respelt(spark):
    sf = "/root/testdata/sf0.001"
    bags = data.bags(spark, sf)
    frequent = stats.word_frequencies(bags).filter(F.col("cf") >= vectorising.SPELLING_FLOOR).select("word")
    asked = frequent.select(F.lit(1).alias("query_id"), F.array("word").alias("words"))
    assert frequent.count() > 100 and vectorising._corrections(spark, sf, bags, asked).count() == 0
    near = tokens.explode_words(asked.limit(1)).select(F.concat(F.col("word"), F.lit("q")).alias("word"))
    assert lexical.spell_candidates(near, frequent.withColumn("n", F.lit(1))).count() <= 1


def test_buckets_rise_with_the_table_past_the_shuffle_partitions(spark, monkeypatch):
    from corpuslab import session

    monkeypatch.setattr(session, "BUCKET_BYTES", 1 << 10)
    table = spark.range(3000).selectExpr("id AS doc_id")
    kept = session.bucketed(table, "doc_id")
    # a count per key reads the buckets in place
    assert kept.groupBy("doc_id").count().rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(3000))


def test_bucket_bytes_stay_bounded():
    from corpuslab.session import BUCKET_BYTES, bucket_number

    for size in (1 << 27, 1 << 30, 6 << 30, 60 << 30):
        assert size / bucket_number(size, 12, 200) <= BUCKET_BYTES <= 8 << 20
    assert bucket_number((1 << 63) - 1, 12, 200) == 200


def test_lemmas_and_spelling_read_their_words_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(word):
        seen.add(1)
        return word

    listed = spark.createDataFrame([("cats",), ("cat",), ("dogs",), ("feet",)], "word string")
    words = listed.select(F.udf(counted)("word").alias("word"))
    lemmas = lexical.lemma_table(words).collect()
    assert seen.value == 4 and {(r.word, r.lemma) for r in lemmas} == {("cats", "cat"), ("feet", "foot")}
    before = seen.value
    vocab = words.filter("word <> 'feet'").withColumn("n", F.lit(1)).filter("word = 'cats'")
    asked = spark.createDataFrame([("cast",), ("cat",)], "word string")
    found = {r.word: r.correction for r in lexical.spell_candidates(asked, vocab).collect()}
    assert found == {"cast": "cats", "cat": "cats"} and seen.value - before <= 8
