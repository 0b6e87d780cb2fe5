"""The end-to-end jobs, put together from the operators.

Each takes tables in and gives tables and fitted models out. Tables that
several later steps read are written once with ``cut_lineage``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.operators import (
    latent, lexical, models, phrases, similarity, tables, tokens, topics, vectors, weights,
)
from corpuslab.session import cut_lineage
from corpuslab.sources.readers import read_text_tree

# Sentiment of short messages


@dataclass(frozen=True)
class SentimentModel:
    word_vectors: DataFrame
    idf: DataFrame
    classifier: PipelineModel
    accuracy: DataFrame


def train_sentiment(
    messages: DataFrame,
    key: str = "item_id",
    text: str = "sentiment_text",
    label: str = "sentiment",
    settings: models.VectorSettings = models.MESSAGE_VECTORS,
    min_df: int = 10,
) -> SentimentModel:
    """Labels 4 and 0 to 1 and 0, tokens, word vectors, idf-weighted means, dense classifier.

    Everything that is fitted sees the training rows only; the held-out rows
    are scaled with the training rows' statistics.
    """
    rows = tables.not_null(messages, label, text).select(
        F.col(key).alias("id"), F.col(text).alias("text"),
        tables.recode(F.col(label), {4: 1, 0: 0}).alias("label"),
    )
    listed = tables.usable_messages(rows, "text", "words").filter("label IS NOT NULL")
    split = cut_lineage(tables.holdout_split(listed.select("id", "label", "words"), "id"))
    train = split.filter("split = 'TRAIN'")
    table = cut_lineage(models.fit_word2vec(train, settings))
    vocab = weights.vocabulary_bounds(train, min_df=min_df)
    idf = cut_lineage(weights.smooth_idf(vocab, weights.document_count(train)).select("word", "idf"))
    means = vectors.weighted_word_vectors(split, table, idf, settings.dim, "id")
    placed = split.select("id", "label", "split").join(means.select("id", "vector"), "id")
    scaled = vectors.standardize(placed, settings.dim, train=F.col("split") == "TRAIN")
    featured = cut_lineage(models.as_features(scaled, "vector"))
    classifier = models.dense_classifier(featured.filter("split = 'TRAIN'"), settings.dim)
    scored = classifier.transform(featured.filter("split = 'TEST'"))
    return SentimentModel(table, idf, classifier, models.accuracy(scored))


# Author of a text


@dataclass(frozen=True)
class AuthorModel:
    leaderboard: DataFrame
    search: CrossValidatorModel
    submission: DataFrame


def classify_authors(
    train: DataFrame,
    unseen: DataFrame,
    key: str = "id",
    topic_settings: topics.TopicSettings = topics.AUTHOR_TOPICS,
    vector_settings: models.VectorSettings = models.AUTHOR_VECTORS,
    min_df: int = 3,
    folds: int = 5,
) -> AuthorModel:
    """Topic and word-vector features, a search per feature set, probabilities for unseen texts.

    ``train`` has key, text, author; ``unseen`` has key, text. The submission
    uses the feature set with the least log loss.
    """
    both = cut_lineage(
        train.select(key, "text", "author", F.lit(True).alias("seen")).unionByName(
            unseen.select(key, "text", F.lit(None).cast("string").alias("author"), F.lit(False).alias("seen"))
        )
    )
    known = both.filter("seen")
    lexicon = tokens.explode_words(tokens.topic_words(known, key, stem=False))
    lemmas = cut_lineage(lexical.lemma_table(lexicon))
    words = cut_lineage(tokens.topic_words(both, key, lemmas=lemmas).join(both.select(key, "seen"), key))
    vocab = weights.vocabulary_bounds(words.filter("seen"), min_df=min_df, max_share=0.8, keep=topics.MAX_VOCABULARY)
    counted = topics.counter(topics.vocabulary_words(vocab)).transform(words)
    topic_model = topics.fit_lda(counted.filter("seen"), topic_settings)
    topic_rows = topics.topic_vectors(topic_model, counted, key).withColumnRenamed("vector", "topics")

    sentence_rows = cut_lineage(tokens.tokenized_sentences(both, key).join(both.select(key, "seen"), key))
    single = sentence_rows.filter("seen").select(F.explode_outer("sentences").alias("words"))
    table = models.fit_word2vec(single.filter("words IS NOT NULL"), vector_settings)
    flat = sentence_rows.select(key, F.flatten("sentences").alias("words"))
    vector_rows = vectors.mean_word_vectors(flat, table, vector_settings.dim, key).select(key, "vector")

    ids = cut_lineage(tables.label_ids(known.select("author"), "author", "label"))
    features = cut_lineage(
        both.select(key, "author", "seen").join(topic_rows, key).join(vector_rows, key).join(ids, "author", "left")
        .withColumn("label", F.col("label").cast("double"))
    )
    boards, searches = [], {}
    for name, columns in {"topics": ["topics"], "vectors": ["vector"], "joined": ["topics", "vector"]}.items():
        estimator, grid = models.logistic_grid()
        featured = models.as_features(features.filter("seen"), *columns).select(key, "label", "features")
        search = models.grid_search(estimator, grid, featured, key, folds)
        searches[name] = (search, columns)
        boards.append(models.leaderboard(search, features, name))
    best, columns = min(searches.values(), key=lambda s: min(s[0].avgMetrics))
    # one row per author
    labels = [r["author"] for r in ids.orderBy("label").collect()]
    scored = best.bestModel.transform(models.as_features(features.filter("NOT seen"), *columns))
    return AuthorModel(tables.append_rows(*boards), best, models.submission(scored, labels, key))


# Intent of an utterance


@dataclass(frozen=True)
class IntentIndex:
    """Labelled vectors (stored_id, vector, intent) and their index, word vectors, words for spelling."""

    labelled: DataFrame
    index: similarity.VectorIndex
    word_vectors: DataFrame
    dim: int
    lexicon: DataFrame
    spelling: DataFrame | None = None

    def vectorize(self, utterances: DataFrame) -> DataFrame:
        """(query_id, vector) of (query_id, text): lower case, spelling, lemmas, stop words out, mean."""
        words = utterances.select("query_id", tx.document_tokens(F.col("text")).alias("words"))
        if self.spelling is not None:
            fixes = lexical.spell_candidates(tokens.explode_words(words), self.spelling)
            words = tokens.map_words(words, fixes.select("word", F.col("correction").alias("lemma")), ["query_id"])
        words = _utterance_lemmas(words, "query_id", self.lexicon)
        return vectors.mean_word_vectors(words, self.word_vectors, self.dim, "query_id")

    def answer(self, utterances: DataFrame) -> DataFrame:
        """(query_id, stored_id, intent, similarity) of the best labelled row."""
        return similarity.best_intent(self.index.nearest(self.vectorize(utterances)), self.labelled)


def _utterance_lemmas(rows: DataFrame, key: str, lexicon: DataFrame) -> DataFrame:
    """Words of utterances as noun lemmas, stop words out."""
    lemmas = lexical.lemma_table(tokens.explode_words(rows), lexicon=lexicon)
    return tokens.map_words(rows, lemmas, [key]).withColumn("words", tx.without(F.col("words")))


def build_intent_index(
    utterances: DataFrame, word_vectors: DataFrame, spelling: DataFrame | None = None
) -> IntentIndex:
    """Index of (stored_id, query, intent) rows with given word vectors.

    ``spelling`` is a (word, n) vocabulary; without it queries are taken as they are.
    """
    dim = vectors.vector_width(word_vectors)
    rows = utterances.select("stored_id", tx.document_tokens(F.col("query")).alias("words"))
    lexicon = cut_lineage(word_vectors.select("word").unionByName(tokens.explode_words(rows)).distinct())
    rows = _utterance_lemmas(rows, "stored_id", lexicon)
    means = vectors.mean_word_vectors(rows, word_vectors, dim, "stored_id")
    labelled = means.select("stored_id", "vector").join(utterances.select("stored_id", "intent"), "stored_id")
    labelled = cut_lineage(labelled)
    return IntentIndex(labelled, similarity.build_index(labelled), word_vectors, dim, lexicon, spelling)


# Word vectors of a folder of texts


def corpus_word_vectors(
    spark: SparkSession, folder: str, settings: models.VectorSettings = models.CORPUS_VECTORS, **scores
) -> DataFrame:
    """(word, vector) over the twice merged sentences of every .txt file below a folder."""
    files = read_text_tree(spark, folder)
    rows = tokens.clean_sentences(files, "path", "content", min_words=3)
    return models.fit_word2vec(phrases.trigrams(rows, ("path", "sent_pos"), **scores), settings)


# Latent search


@dataclass(frozen=True)
class LatentIndex:
    factors: latent.Factors
    documents: DataFrame

    def search(self, text: str) -> DataFrame:
        """Documents by falling similarity to one query text."""
        return latent.lsi_query(text, self.factors, self.documents).orderBy(F.desc("similarity"))


def build_latent_index(
    matrix: DataFrame, k: int = 6, share: float = 0.85, keep: int | None = None
) -> LatentIndex:
    """Index of a (doc_id, term, value) table: positive cells count as 1, ``share`` of the energy is kept."""
    rows = cut_lineage(
        matrix.filter("value > 0").groupBy("doc_id").agg(F.collect_set("term").alias("words"))
    )
    vocab = weights.vocabulary_bounds(rows, keep=keep)
    factors = latent.reduce_rank(latent.svd(rows, vocab, k), share)
    folded = latent.fold_in(latent.binary_weights(rows), factors.words, factors.values, factors.k)
    return LatentIndex(factors, cut_lineage(folded))
