"""From documents to packed training sequences: the stages of a corpus, each over all that the one before kept.

Every stage takes and returns whole documents (all columns); the last returns
the pieces of the packed sequences. A stage's rows are written as Parquet and
read again by the next, so that no stage is computed twice and a lost executor
costs only the tasks it ran. Stages that run Python bound the bytes of the
session's Arrow batches, which hold whole documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslab.llm import decontam, minhash, packing, pii, quality, store
from corpuslab.llm.queries import table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id."""
    store.bound_batches(spark)
    return minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    store.bound_batches(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    store.bound_batches(spark)
    return pii.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in sequences of 2048."""
    store.bound_batches(spark)
    return packing.pack(packing.pieces(docs, tokenizer_path(), slice_bytes=1 << 19))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# the sampling, the masks and the packing are beyond SQL; tests/llm/test_pipeline.py checks each stage
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = store.keep(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
