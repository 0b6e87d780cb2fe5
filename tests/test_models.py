import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from corpuslab.operators import models, topics, vectors

THEMES = ["apple pear plum fig grape".split(), "car bus tram train truck".split()]


@pytest.fixture(scope="module")
def themed(spark):
    rng = random.Random(3)
    rows = [(i, i % 2, [rng.choice(THEMES[i % 2]) for _ in range(12)]) for i in range(80)]
    return spark.createDataFrame(rows, "doc_id long, theme int, words array<string>").cache()


def test_topics_are_distributions(spark, themed):
    words = sorted(THEMES[0] + THEMES[1])
    features = topics.counter(words).transform(themed)
    settings = topics.TopicSettings(k=2, passes=10, offset=10.0, batch_share=0.5, seed=1)
    model = topics.fit_lda(features, settings)
    rows = topics.doc_topics(model, features)
    totals = rows.groupBy("doc_id").agg(F.sum("score").alias("t")).collect()
    assert len(totals) == 80 and all(abs(r["t"] - 1) < 1e-6 for r in totals)
    assert topics.doc_topics(model, features, min_probability=0.5).count() <= 80
    top = topics.topic_top_words(model, topics.vocabulary_table(spark, words), 5)
    assert top.count() == 10
    vecs = topics.topic_vectors(model, features).join(themed.select("doc_id", "theme"), "doc_id")
    best = topics.author_top_topics(vecs, top, 2, n=1, author="theme").collect()
    assert {r["theme"] for r in best} == {0, 1}


def test_asymmetric_prior():
    prior = topics.asymmetric_prior(5)
    assert sum(prior) == pytest.approx(1.0) and prior == sorted(prior, reverse=True)


def test_uncapped_vocabulary_is_refused(spark):
    vocab = spark.range(topics.MAX_VOCABULARY + 1).select(F.col("id").cast("string").alias("word"))
    with pytest.raises(ValueError):
        topics.vocabulary_words(vocab)


def test_word2vec_then_mean_ignores_unknown_words(spark, themed):
    settings = models.VectorSettings(dim=4, min_count=1, max_iter=1, seed=7)
    table = models.fit_word2vec(themed, settings)
    assert table.count() == 10
    rows = spark.createDataFrame([(1, ["apple"]), (2, ["apple", "unheard"])], "doc_id long, words array<string>")
    got = {r["doc_id"]: r["vector"] for r in vectors.mean_word_vectors(rows, table, 4).collect()}
    assert got[1] == pytest.approx(got[2])


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(9)
    rows = []
    for i in range(120):
        c = i % 2
        rows.append((i, float(c), [rng.gauss(4 * c, 1), rng.gauss(-4 * c, 1), 5.0]))
    return spark.createDataFrame(rows, "doc_id long, label double, vector array<double>").cache()


def test_kmeans_finds_the_groups(points):
    model, rows = models.kmeans_docs(points, 2, seed=1)
    pairs = rows.select("label", "cluster").distinct().count()
    assert pairs == 2 and len(model.clusterCenters()) == 2


def test_pca_is_centred(points):
    means = models.pca_2d(points).agg(F.avg("x"), F.avg("y")).first()
    assert means[0] == pytest.approx(0, abs=1e-6) and means[1] == pytest.approx(0, abs=1e-6)


def test_dense_classifier_beats_majority(points):
    rows = points.withColumn("features", array_to_vector("vector"))
    model = models.dense_classifier(rows, 3, hidden=4, epochs=30, seed=1)
    assert models.accuracy(model.transform(rows)).first()["accuracy"] > 0.9


def test_grid_search_and_submission(points):
    rows = models.as_features(points, "vector")
    estimator, grid = models.logistic_grid(max_iter=10)
    search = models.grid_search(estimator, grid, rows, folds=3)
    board = models.leaderboard(search, rows, "all").orderBy("rank").collect()
    assert len(board) == 2 and board[0]["log_loss"] == min(search.avgMetrics)
    out = models.submission(search.bestModel.transform(rows), ["zero", "one"]).collect()
    assert all(abs(r["zero"] + r["one"] - 1) < 1e-9 for r in out)
    assert any(r["zero"] > 0.9 for r in out) and any(r["one"] > 0.9 for r in out)


def test_nmf_separates_the_themes(spark, themed):
    words = sorted(THEMES[0] + THEMES[1])
    weighed = themed.select("doc_id", F.explode("words").alias("word")).groupBy("doc_id", "word").agg(
        F.count("*").cast("double").alias("weight")
    )
    factors, docs = topics.nmf_topics(weighed, words, topics.FactorSettings(k=2, passes=8))
    top = {
        t: {r["word"] for r in factors.filter(F.col("topic") == t).orderBy(F.desc("weight")).limit(5).collect()}
        for t in (0, 1)
    }
    assert sorted(map(sorted, top.values())) == sorted(map(sorted, THEMES))
    assert factors.filter("weight < 0").count() == 0 and docs.count() == 80


def test_long_heads_are_cut_by_position(spark, monkeypatch):
    from corpuslab.operators import ordering

    monkeypatch.setattr(ordering, "SHORT_HEAD", 5)
    df = spark.range(1000).withColumn("n", (F.col("id") * 7919) % 100).repartition(9)
    want = sorted(((-r["n"], r["id"]) for r in df.collect()))[:37]
    got = ordering.head(df, 37, F.desc("n"), "id", leading=-F.col("n")).collect()
    assert [(-r["n"], r["id"]) for r in got] == want
    for n in (3, 1000, 5000):  # ordered whatever the size
        assert [r["id"] for r in ordering.head(df, n, "id").collect()] == list(range(min(n, 1000)))


def test_counts_equal_those_of_spark_and_ask_the_driver_for_no_single_word(spark, themed, monkeypatch):
    from pyspark.ml.feature import CountVectorizerModel

    words = sorted(THEMES[0] + THEMES[1][:3])
    some = [(1, 0, ["apple", "zebra", "apple", None, "car"]), (2, 0, []), (3, 0, ["zebra"])]
    rows = themed.unionByName(spark.createDataFrame(some, themed.schema)).repartition(3)
    for binary in (False, True):
        plain = CountVectorizerModel.from_vocabulary(words, inputCol="words", outputCol="features")
        want = {r.doc_id: r.features for r in plain.setBinary(binary).setMinTF(1.0).transform(rows).collect()}
        with monkeypatch.context() as m:
            m.setattr(CountVectorizerModel, "from_vocabulary", None)
            got = topics.counter(words, binary).transform(rows)
            assert {r.doc_id: r.features for r in got.collect()} == want
    assert topics.counter([]).transform(rows).first().features.size == 0
    weighed = topics.idf_weigher(words, {w: 2.0 for w in words}).transform(rows).select("features").collect()
    assert {round(r.features.norm(2), 9) for r in weighed} == {0.0, 1.0}
