"""Register a query together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _wide_integers(df: DataFrame) -> DataFrame:
    """Counts and positions as bigint, the type the checking SQL returns."""
    return df.select(
        *[F.col(f"`{c}`").cast("bigint").alias(c) if t == "int" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _wide_integers(build(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
