"""Word vectors, clustering, classification and model selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.operators import skipgram
from corpuslab.operators.tables import hash_bucket


@dataclass(frozen=True)
class VectorSettings:
    dim: int
    min_count: int
    window: int = 5
    max_iter: int = 1
    negative: int = 5
    sample: float = 1e-3
    seed: int = 786


MESSAGE_VECTORS = VectorSettings(dim=200, min_count=10)
CORPUS_VECTORS = VectorSettings(dim=3, min_count=1, window=10)
PHRASE_VECTORS = VectorSettings(dim=300, min_count=5)
TUNED_PHRASE_VECTORS = VectorSettings(dim=300, min_count=10, max_iter=150)
AUTHOR_VECTORS = VectorSettings(dim=200, min_count=3, window=6, max_iter=6)


def fit_word2vec(sentences: DataFrame, settings: VectorSettings, words: str = "words") -> DataFrame:
    """(word, vector) from a skip-gram model over one row per sentence, the same for any partitioning.

    Vocabulary and parameters stay in blocks on the executors (see ``skipgram``).
    """
    return skipgram.fit(
        sentences,
        skipgram.Settings(
            dim=settings.dim, min_count=settings.min_count, window=settings.window, passes=settings.max_iter,
            negative=settings.negative, sample=settings.sample, seed=settings.seed,
        ),
        words,
    )


def as_features(df: DataFrame, *vectors: str, name: str = "features") -> DataFrame:
    """Put array columns side by side as one model vector."""
    return df.withColumn(name, array_to_vector(F.concat(*vectors)))


def kmeans_docs(df: DataFrame, k: int = 5, seed: int = 0) -> tuple[KMeansModel, DataFrame]:
    """Model, and the rows with ``cluster``."""
    rows = as_features(df, "vector")
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)
    return model, model.transform(rows).drop("features")


def cluster_members(clustered: DataFrame, key: str = "doc_id") -> DataFrame:
    """(cluster, key) rows; a cluster may hold most rows, so it stays a column."""
    return clustered.select("cluster", key)


def pca_2d(df: DataFrame, key: str = "doc_id", k: int = 2) -> DataFrame:
    """(key, x, y): centred rows on the leading components."""
    pipeline = Pipeline(
        stages=[
            StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="centred"),
            PCA(k=k, inputCol="centred", outputCol="components"),
        ]
    )
    rows = as_features(df, "vector")
    projected = pipeline.fit(rows).transform(rows)
    array = vector_to_array("components")
    return projected.select(key, F.get(array, 0).alias("x"), F.get(array, 1).alias("y"))


def dense_classifier(
    train: DataFrame, dim: int, hidden: int = 32, epochs: int = 9, batch: int = 32, seed: int = 0
) -> PipelineModel:
    """One hidden layer over ``features``, two classes in ``label``."""
    network = MultilayerPerceptronClassifier(
        layers=[dim, hidden, 2], maxIter=epochs, blockSize=batch, seed=seed
    )
    return Pipeline(stages=[network]).fit(train)


def accuracy(scored: DataFrame, label: str = "label") -> DataFrame:
    hit = F.when(F.col("prediction") == F.col(label), 1.0).otherwise(0.0)
    return scored.agg(F.avg(hit).alias("accuracy"), F.count("*").alias("n_rows"))


def logistic_grid(penalties: Mapping[str, float] | None = None, reg: float = 0.01, max_iter: int = 50):
    """Estimator and grid over the L1 and L2 penalties."""
    model = LogisticRegression(regParam=reg, maxIter=max_iter)
    mix = list((penalties or {"l1": 1.0, "l2": 0.0}).values())
    return model, ParamGridBuilder().addGrid(model.elasticNetParam, mix).build()


def grid_search(
    estimator: Estimator, grid: Sequence, rows: DataFrame, key: str = "doc_id",
    folds: int = 5, parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated log loss; the best setting is refitted on all rows.

    Folds come from a hash of the key, so they do not depend on partitioning.
    The rows are kept for the many fits.
    """
    placed = rows.withColumn("_fold", hash_bucket(F.concat_ws("#", F.lit("fold"), F.col(key)), folds))
    placed = placed.persist()
    try:
        return CrossValidator(
            estimator=estimator,
            estimatorParamMaps=list(grid),
            evaluator=MulticlassClassificationEvaluator(metricName="logLoss"),
            numFolds=folds,
            foldCol="_fold",
            parallelism=parallelism,
        ).fit(placed)
    finally:
        placed.unpersist()


def leaderboard(search: CrossValidatorModel, rows: DataFrame, name: str) -> DataFrame:
    """(features, setting, log_loss, deviation, rank); one row per grid cell."""
    entries = []
    for params, mean, dev in zip(search.getEstimatorParamMaps(), search.avgMetrics, search.stdMetrics):
        setting = ", ".join(f"{p.name}={v}" for p, v in params.items())
        entries.append((name, setting, float(mean), float(dev)))
    entries.sort(key=lambda e: e[2])
    ranked = [(*e, i) for i, e in enumerate(entries, start=1)]
    return rows.sparkSession.createDataFrame(
        ranked, "features string, setting string, log_loss double, deviation double, rank int"
    )


def submission(scored: DataFrame, labels: Sequence[str], key: str = "doc_id") -> DataFrame:
    """Key and one probability column per label, in label order."""
    p = vector_to_array("probability")
    return scored.select(key, *[F.get(p, i).alias(label) for i, label in enumerate(labels)])
