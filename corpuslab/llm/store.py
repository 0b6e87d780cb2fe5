"""Tables written between the steps of one operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folder: str | None = None

# Bytes of the rows that Spark sends to a Python worker at a time; a longer row goes alone.
BATCH_BYTES = 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python in batches of ``BATCH_BYTES``, however many rows that are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting (as in tests) gets a folder of
    its own.
    """
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_folder is None or not os.path.isdir(_local_folder):
        _local_folder = tempfile.mkdtemp(prefix="corpuslab-llm-")
    return _local_folder


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, deleted when the session's file system closes."""
    path = f"{shared_folder(spark)}/corpuslab-llm/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def keep(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Lineage ends here: an executor that is lost later costs no recomputation of
    what stands before, and readers prune columns.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def least_hashed(df: DataFrame, column: str, most: int) -> DataFrame:
    """The ``most`` rows with the least values of ``column``.

    Tasks send their least values alone; the rows are picked by the value that
    ends the list, so that no task sends rows that are dropped again.
    """
    last = df.select(column).orderBy(column).limit(most).agg(F.max(column)).first()[0]
    return df.filter(F.col(column) <= last).orderBy(column).limit(most)
