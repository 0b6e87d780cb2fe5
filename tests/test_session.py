"""What written tables leave on disk."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpuslab import session


def shuffled(spark):
    return spark.range(20_000).repartition(8, "id").groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))


@pytest.mark.parametrize("write", [session.cut_lineage, session.stored, lambda df: session.bucketed(df, "k")])
def test_no_shuffle_files_stay_behind_a_written_table(spark, write):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return sum(1 for d in folders for _ in Path(d).rglob("shuffle_*.data"))

    at_first = files()
    table = write(shuffled(spark))
    for _ in range(50):
        if files() <= at_first:
            break
        time.sleep(0.2)
    assert files() <= at_first and table.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_stored_table_can_be_discarded(spark):
    table = session.stored(shuffled(spark))
    folder = Path(table._stored_path.removeprefix("file:"))
    assert session.is_stored(table) and not session.is_stored(shuffled(spark)) and any(folder.iterdir())
    session.discard(table)
    assert not folder.exists()
