"""Fitted models: word vectors, topics, latent search, clusters, classifiers (survey J9-J29)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuslab.operators import (
    latent, models, ordering, phrases, tables, tokens, topics, vectors, weights,
)
from corpuslab.operators.unnest import each
from corpuslab.plans import data
from corpuslab.plans.registry import query
from corpuslab.plans.sqlparts import parts
from corpuslab.plans.vectorising import WIDTH, document_vectors
from corpuslab.session import cut_lineage, stored
from corpuslab.sources.readers import read_table

# Settings small enough for the test tables; the operators' own presets hold
# the sizes of the original workloads.
MESSAGE_VECTORS = models.MESSAGE_VECTORS
PHRASE_VECTORS = models.PHRASE_VECTORS
SENTENCE_TOPICS = replace(topics.SENTENCE_TOPICS, batch_share=0.25)
HEADLINE_TOPICS = replace(topics.HEADLINE_TOPICS, batch_share=0.25)
AUTHOR_TOPICS = replace(topics.AUTHOR_TOPICS, k=10, passes=4, batch_share=0.25)


# Word vectors


def _message_vectors(spark, sf):
    rows = data.clean(spark, sf, min_words=3)
    return models.fit_word2vec(rows, MESSAGE_VECTORS)


def _vector_rows(df, *keys):
    return vectors.explode_vector(df, *keys)


@query("word2vec_fit")
def word2vec_fit(spark, sf):
    """Skip-gram vectors over cleaned sentences."""
    return _vector_rows(_message_vectors(spark, sf), "word")


@query("word2vec_phrases")
def word2vec_phrases(spark, sf):
    """Vectors over sentences with merged word pairs."""
    merged = phrases.bigrams(data.clean(spark, sf, min_words=3))
    return _vector_rows(models.fit_word2vec(merged, PHRASE_VECTORS), "word")


@query("word2vec_trigrams")
def word2vec_trigrams(spark, sf):
    """Three-dimensional vectors over twice merged sentences, every word kept."""
    merged = phrases.trigrams(data.clean(spark, sf, min_words=3))
    return _vector_rows(models.fit_word2vec(merged, models.CORPUS_VECTORS), "word")


@query("word2vec_authors")
def word2vec_authors(spark, sf):
    """Vectors over masked, full-stop sentences."""
    rows = tokens.tokenized_sentences(data.documents(spark, sf))
    single = each(rows, "sentences", "words")
    return _vector_rows(models.fit_word2vec(single, models.AUTHOR_VECTORS), "word")


@query("doc_vectors")
def doc_vectors(spark, sf):
    """Mean of known word vectors per sentence of merged words."""
    merged = phrases.bigrams(data.clean(spark, sf, min_words=3)).withColumn(
        "sent_id", F.concat_ws("-", "doc_id", "sent_pos")
    )
    merged = stored(merged)
    table = models.fit_word2vec(merged, PHRASE_VECTORS)
    vecs = vectors.mean_word_vectors(merged, table, PHRASE_VECTORS.dim, "sent_id")
    return vecs.select("sent_id", "known", "total", F.round(F.get("vector", F.lit(0)), 6).alias("first"))


@query("weighted_doc_vectors")
def weighted_doc_vectors(spark, sf):
    """Mean of vector times idf over words that have both."""
    rows = data.words(spark, sf)
    vocab = weights.vocabulary_bounds(rows, min_df=10)
    idf = weights.smooth_idf(vocab, weights.document_count(rows))
    vecs = vectors.weighted_word_vectors(rows, _message_vectors(spark, sf), idf, MESSAGE_VECTORS.dim)
    return _vector_rows(vecs, "doc_id")


# Topics


def _counted(rows, **bounds):
    """Count vectors over a capped vocabulary, and the vocabulary."""
    vocab = weights.vocabulary_bounds(rows, **bounds)
    listed = topics.vocabulary_words(vocab)
    return topics.counter(listed).transform(rows), listed


def _sentence_features(spark, sf):
    rows = cut_lineage(data.clean(spark, sf))
    rows = rows.withColumn("sent_id", F.concat_ws("-", "doc_id", "sent_pos")).withColumn(
        "words", F.filter("words", lambda w: F.length(w) >= 2)
    )
    return _counted(rows, min_df=2, max_share=0.95, keep=1000, by="cf")


def _headline_rows(spark, sf):
    return cut_lineage(tokens.headline_words(data.documents(spark, sf)))


def _headline_model(spark, sf):
    features, listed = _counted(_headline_rows(spark, sf), min_df=15, max_share=0.5, keep=100_000)
    return topics.fit_lda(features, HEADLINE_TOPICS), features, listed


@query("lda_fit")
def lda_fit(spark, sf):
    """Five topics over sentences: the ten strongest words of each."""
    features, listed = _sentence_features(spark, sf)
    model = topics.fit_lda(features, SENTENCE_TOPICS)
    return topics.topic_top_words(model, topics.vocabulary_table(spark, listed), 10)


@query("topic_top_words")
def topic_top_words(spark, sf):
    """Ten topics over headlines by counts."""
    model, _, listed = _headline_model(spark, sf)
    return topics.topic_top_words(model, topics.vocabulary_table(spark, listed), 10)


@query("lda_tf_idf")
def lda_tf_idf(spark, sf):
    """Ten topics over headlines by log2 TF-IDF weights."""
    rows = _headline_rows(spark, sf)
    vocab = weights.vocabulary_bounds(rows, min_df=15, max_share=0.5, keep=100_000)
    idf = weights.log2_idf(vocab, weights.document_count(rows)).select("word", "idf")
    # at most keep rows
    table = {r["word"]: r["idf"] for r in idf.collect()}
    listed = sorted(table)
    features = topics.idf_weigher(listed, table).transform(rows)
    model = topics.fit_lda(features, HEADLINE_TOPICS)
    return topics.topic_top_words(model, topics.vocabulary_table(spark, listed), 10)


@query("nmf_topics")
def nmf_topics(spark, sf):
    """Five non-negative factors of the TF-IDF table: ten strongest words of each."""
    rows = cut_lineage(data.words(spark, sf))
    bounds = dict(min_df=2, max_share=0.95, keep=1000, by="cf")
    listed = topics.vocabulary_words(weights.vocabulary_bounds(rows, **bounds))
    weighed = weights.tf_idf_smooth(rows, **bounds)
    factors, _ = topics.nmf_topics(weighed, listed, topics.FactorSettings(k=5, passes=5))
    return ordering.top_per_group(factors, "topic", 10, F.desc("weight"), "word")


@query("doc_topics")
def doc_topics(spark, sf):
    """Full topic distribution of every document."""
    model, features, _ = _headline_model(spark, sf)
    return topics.doc_topics(model, features)


@query("doc_topics_ranked")
def doc_topics_ranked(spark, sf):
    """Topics of every document by score, at least 0.01."""
    model, features, _ = _headline_model(spark, sf)
    return topics.doc_topics_ranked(model, features)


@query("score_unseen_document")
def score_unseen_document(spark, sf):
    """Topics of user turns under a model fitted on the documents."""
    model, _, listed = _headline_model(spark, sf)
    unseen = tokens.headline_words(data.utterances(spark, sf), key="query_id")
    features = topics.counter(listed).transform(unseen)
    return topics.doc_topics_ranked(model, features, "query_id")


def _author_topics(spark, sf, split=None):
    """Model, topics of every document, vocabulary; learnt from the documents of one split where it is named."""
    rows = cut_lineage(tables.holdout_split(tokens.topic_words(data.documents(spark, sf)), "doc_id"))
    seen = rows if split is None else rows.filter(F.col("split") == split)
    listed = topics.vocabulary_words(
        weights.vocabulary_bounds(seen, min_df=3, max_share=0.8, keep=topics.MAX_VOCABULARY)
    )
    features = topics.counter(listed).transform(rows)
    model = topics.fit_lda(topics.counter(listed).transform(seen), AUTHOR_TOPICS)
    authors = read_table(spark, sf, "documents").select("doc_id", F.col("lang").alias("author"))
    return model, topics.topic_vectors(model, features).join(authors, "doc_id"), listed


@query("author_top_topics")
def author_top_topics(spark, sf):
    """Five strongest topics per author with their words."""
    model, vecs, listed = _author_topics(spark, sf)
    words = topics.topic_top_words(model, topics.vocabulary_table(spark, listed), 5)
    return topics.author_top_topics(vecs, words, AUTHOR_TOPICS.k)


@query("mean_topics_by_author")
def mean_topics_by_author(spark, sf):
    """Mean topic distribution per author."""
    _, vecs, _ = _author_topics(spark, sf)
    return _vector_rows(vectors.mean_vector_by(vecs, "author", AUTHOR_TOPICS.k), "author")


# Latent search

FACTORS = 6
QUERY_TEXT = "reading stations that were tied"


def _stemmed(spark, sf):
    docs = data.documents(spark, sf)
    return stored(latent.query_words(docs, key="doc_id"))


def _factors(spark, sf):
    rows = _stemmed(spark, sf)
    vocab = weights.vocabulary_bounds(rows, min_df=3, max_share=0.9)
    return rows, latent.svd(rows, vocab, FACTORS)


@query("svd")
def svd(spark, sf):
    """Word loadings on the leading factors."""
    _, factors = _factors(spark, sf)
    return _vector_rows(factors.words, "word")


@query("singular_values")
def singular_values(spark, sf):
    """Singular values, greatest first."""
    return _factors(spark, sf)[1].values


@query("reduce_rank")
def reduce_rank(spark, sf):
    """Loadings on the factors that hold 85 % of the energy."""
    _, factors = _factors(spark, sf)
    return _vector_rows(latent.reduce_rank(factors).words, "word")


@query("lsi_documents")
def lsi_documents(spark, sf):
    """Documents folded into the kept factors."""
    rows, factors = _factors(spark, sf)
    kept = latent.reduce_rank(factors)
    return _vector_rows(latent.fold_in(latent.binary_weights(rows), kept.words, kept.values, kept.k), "doc_id")


@query("lsi_query")
def lsi_query(spark, sf):
    """Every document's similarity to one query text, ranked."""
    rows, factors = _factors(spark, sf)
    kept = latent.reduce_rank(factors)
    docs = latent.fold_in(latent.binary_weights(rows), kept.words, kept.values, kept.k)
    scored = latent.lsi_query(QUERY_TEXT, kept, docs)
    return scored.select("doc_id", "similarity").orderBy(F.desc("similarity"), "doc_id")


@query(
    "fold_in",
    parts("post", "wv_long")
    + """, e AS (SELECT dim, sqrt(sum(x * x)) AS s FROM (SELECT generate_subscripts(embedding, 1) - 1 AS dim,
               CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY dim)
         SELECT doc_id, dim, round(sum(v / s), 6) AS value
         FROM post JOIN wv_long USING (word) JOIN e USING (dim) GROUP BY doc_id, dim""",
)
def fold_in(spark, sf):
    """Binary document rows folded through a given factor table."""
    rows = data.words(spark, sf)
    table = data.word_vectors(spark, sf, rows).select("word", "vector")
    long = data.embeddings(spark, sf).select(F.posexplode("vector").alias("dim", "x"))
    values = long.groupBy("dim").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("s"))
    values = values.select((F.col("dim") + 1).alias("rank"), "s")
    return _vector_rows(latent.fold_in(latent.binary_weights(rows), table, values, WIDTH), "doc_id")


# Clusters


@query("kmeans_docs")
def kmeans_docs(spark, sf):
    """Cluster of every document."""
    _, rows = models.kmeans_docs(cut_lineage(document_vectors(spark, sf)), 5)
    return rows.select("doc_id", "cluster")


@query("cluster_centres")
def cluster_centres(spark, sf):
    """Centre of every cluster."""
    model, _ = models.kmeans_docs(cut_lineage(document_vectors(spark, sf)), 5)
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return _vector_rows(spark.createDataFrame(centres, "cluster int, vector array<double>"), "cluster")


@query("cluster_members")
def cluster_members(spark, sf):
    """Sentences of every cluster with their number in the cluster."""
    _, rows = models.kmeans_docs(cut_lineage(document_vectors(spark, sf)), 5)
    return ordering.index_within(models.cluster_members(rows), "cluster", ["doc_id"], "member")


@query("pca_2d")
def pca_2d(spark, sf):
    """Documents on the two leading components."""
    return models.pca_2d(cut_lineage(document_vectors(spark, sf)))


# Classifiers


def _sentiment_rows(spark, sf):
    labels = tables.not_null(data.messages(spark, sf), "sentiment").select(
        "doc_id", tables.recode(F.col("sentiment"), {4: 1, 0: 0}).alias("label")
    )
    labels = tables.holdout_split(labels.filter("label IS NOT NULL"), "doc_id")
    bags = data.bags(spark, sf).join(labels.select("doc_id", "split"), "doc_id")
    # idf, scale and network learn from the training rows alone
    idf = weights.vocabulary_bounds(train := bags.filter("split = 'TRAIN'"), min_df=10)
    idf = weights.smooth_idf(idf, weights.document_count(train))
    table = data.word_vectors(spark, sf, data.bags(spark, sf))
    split = vectors.weighted_word_vectors(bags, table, idf, WIDTH).join(labels, "doc_id")
    scaled = vectors.standardize(cut_lineage(split), WIDTH, train=F.col("split") == "TRAIN")
    return cut_lineage(models.as_features(scaled, "vector").select("doc_id", "label", "split", "features"))


def _sentiment_scored(spark, sf):
    rows = _sentiment_rows(spark, sf)
    model = models.dense_classifier(rows.filter("split = 'TRAIN'"), WIDTH)
    return model.transform(rows.filter("split = 'TEST'"))


@query("dense_classifier")
def dense_classifier(spark, sf):
    """Predicted label of every held-out message."""
    return _sentiment_scored(spark, sf).select("doc_id", "label", "prediction")


@query("accuracy")
def accuracy(spark, sf):
    """Share of held-out messages predicted right."""
    return models.accuracy(_sentiment_scored(spark, sf))


def _author_rows(spark, sf, split=None):
    """Topic features, vector features and the author's id for every document."""
    _, topic_rows, _ = _author_topics(spark, sf, split)
    ids = tables.label_ids(read_table(spark, sf, "documents").select(F.col("lang").alias("author")), "author", "label")
    rows = (
        topic_rows.withColumnRenamed("vector", "topics")
        .join(document_vectors(spark, sf).select("doc_id", "vector"), "doc_id")
        .join(ids, "author")
        .withColumn("label", F.col("label").cast("double"))
    )
    return cut_lineage(rows)


FEATURE_SETS = {"topics": ["topics"], "vectors": ["vector"], "joined": ["topics", "vector"]}


def _search(rows, columns):
    estimator, grid = models.logistic_grid(max_iter=15)
    featured = models.as_features(rows, *columns).select("doc_id", "label", "features")
    return models.grid_search(estimator, grid, featured, folds=3)


def _leaderboards(spark, sf):
    rows = _author_rows(spark, sf)
    boards = [models.leaderboard(_search(rows, c), rows, name) for name, c in FEATURE_SETS.items()]
    return tables.append_rows(*boards)


@query("grid_search")
def grid_search(spark, sf):
    """Best settings on the joined features: the five best rows."""
    rows = _author_rows(spark, sf)
    board = models.leaderboard(_search(rows, FEATURE_SETS["joined"]), rows, "joined")
    return ordering.head(board, 5, "rank", "setting")


@query("author_logistic")
def author_logistic(spark, sf):
    """L1 and L2 on topic, vector and joined features."""
    return _leaderboards(spark, sf)


@query("model_scores")
def model_scores(spark, sf):
    """Best log loss per feature set, ranked."""
    best = _leaderboards(spark, sf).filter("rank = 1").select("features", "setting", "log_loss")
    # one row per feature set
    return best.withColumn("rank", F.rank().over(W.orderBy("log_loss")))


@query("submission")
def submission(spark, sf):
    """Probability of each author for every held-out document."""
    rows = tables.holdout_split(_author_rows(spark, sf, "TRAIN"), "doc_id")
    featured = models.as_features(rows, *FEATURE_SETS["joined"])
    # one row per label
    labels = [r["author"] for r in rows.select("author", "label").distinct().orderBy("label").collect()]
    estimator, _ = models.logistic_grid(max_iter=15)
    model = estimator.fit(featured.filter("split = 'TRAIN'"))
    return models.submission(model.transform(featured.filter("split = 'TEST'")), labels)
