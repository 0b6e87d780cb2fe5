"""Session set-up, lineage cuts and input spreading."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "corpuslab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    On a cluster ``master`` and the resource settings come from spark-submit;
    nothing here overrides them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # written intermediates go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpuslab-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is planned and written meanwhile leaves no shuffle files; else they stay until the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder.

    The result keeps its partitions and row order, and survives the loss of
    executors because it is read back from the shared folder. Its files hold
    rows as they are in memory; a large table takes a fraction of them where it
    is ``stored``.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    with _shuffles_go(df.sparkSession):
        # a plan of its own: the setting counts from when a plan is made
        return df.select("*").checkpoint()


def stored(df: DataFrame, *folders: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder, a folder for each value of ``folders``, and read back.

    Unlike a checkpoint the table has the size of its files, so the estimates
    of plans that are built step upon step do not multiply, and readers prune
    columns. The files go when the session's file system closes.
    """
    path = _new_table(df.sparkSession)
    with _shuffles_go(df.sparkSession):
        df.write.partitionBy(*folders).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stored_path = path
    return table


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is a table as ``stored`` gave it back."""
    return getattr(df, "_stored_path", None) is not None


def discard(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more, before the session ends."""
    spark = table.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(table._stored_path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _new_table(spark: SparkSession) -> str:
    _ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/tables/{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


# Estimated bytes of a bucket. Buckets rise with the table, so that what a task holds does not.
BUCKET_BYTES = 8 << 20
# Files of one folder; a bucket grows only beyond this many (256 GiB of estimated bytes).
MOST_BUCKETS = 32_768


# From here on an estimate says that the planner knows nothing of the table.
_UNKNOWN = 1 << 60


def bucket_number(size: int, cores: int, partitions: int) -> int:
    """Buckets for a table of ``size`` estimated bytes; as many as shuffle ``partitions`` where nothing is known."""
    if size >= _UNKNOWN:
        return max(cores, partitions)
    return min(MOST_BUCKETS, max(cores, -(-size // BUCKET_BYTES)))


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written in the shared checkpoint folder, in buckets of ``key``.

    Moving whole rows once is several times less than moving what they hold,
    and every later step per key (sums, norms, ranks) finds its rows in place:
    the table is read back by bucket, and nothing is shuffled by key again.
    """
    spark = df.sparkSession
    # the planner's estimate of the bytes only says how many buckets are worth opening
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    number = bucket_number(
        size, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    name = f"corpuslab_{uuid.uuid4().hex}"
    placed = df.repartition(number, key).write.bucketBy(number, key).option("path", _new_table(spark))
    with _shuffles_go(spark):
        placed.saveAsTable(name)
    return spark.table(name)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, for sessions started without ``--py-files``."""
    context = spark.sparkContext
    if getattr(context, "_corpuslab_shipped", False):
        return
    here = pathlib.Path(__file__).resolve().parent
    held = pathlib.Path(tempfile.mkdtemp(prefix="corpuslab-package-")) / "corpuslab_package.zip"
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(here.rglob("*.py")):
            out.write(path, pathlib.Path(here.name) / path.relative_to(here))
    context.addPyFile(str(held))
    context._corpuslab_shipped = True


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition only when the scan has fewer partitions than there are cores.

    A table of many files is returned untouched, so nothing is shuffled at
    scale; one small file is spread so that tokenising uses every core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


# Largest lookup table that is sent to every executor.
BROADCAST_BYTES = 128 << 20


def _cell_bytes(name: str, kind: str) -> Column:
    column = F.col(f"`{name}`")
    if kind in ("string", "binary"):
        return F.octet_length(column)
    if kind == "array<string>":
        return F.octet_length(F.array_join(column, "")) + F.size(column) * 16
    if kind.startswith("array<") and not any(k in kind for k in ("string", "binary", "struct", "map", "array<array")):
        return F.size(column) * 16
    if any(k in kind for k in ("array", "struct", "map")):
        # what it takes as text is no less than it takes as rows, but for the slots of short fields
        return F.octet_length(F.to_json(F.struct(column.alias("v")))) * 2
    return F.lit(16)


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written, and the bytes of its rows."""
    written = cut_lineage(df)
    row = sum((F.coalesce(_cell_bytes(n, t), F.lit(0)) for n, t in written.dtypes), F.lit(16))
    return written, written.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def lookup(df: DataFrame) -> DataFrame:
    """A table that single words or pairs are looked up in.

    The table is written and its bytes are added up. Below the limit it is
    marked for broadcast, so the rows that look words up are not shuffled by
    word at all; above it Spark joins by shuffle and splits hot words.
    """
    written, size = measured(df)
    return F.broadcast(written) if size <= BROADCAST_BYTES else written
