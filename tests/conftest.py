from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpuslab.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one expression over one string (or None)."""
    from pyspark.sql import functions as F

    def run(expression, text):
        df = spark.createDataFrame([(text,)], "x string")
        return df.select(expression(F.col("x")).alias("y")).first()["y"]

    return run
