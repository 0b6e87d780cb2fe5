"""Every query with checking SQL gives the same rows on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare

SF = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    frame = contract.queries()[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    got = frame.toPandas()
    want = db.execute(ORACLES[name]).df()
    assert compare(got, want).startswith("ok")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["doc_id", "rank", "word", "weight"] and rows.count() > 0


def test_scans_read_only_the_columns_they_need(spark):
    plan = contract.queries()["docs_by_author"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,fr)" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in plan
    words = contract.queries()["doc_frequency"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in words


def test_flagship_moves_no_text(spark):
    """Bags are stored by document; counting, norm and rank then need no further shuffle."""
    plan = contract.entry(spark)._jdf.queryExecution().executedPlan().toString()
    body = plan.split("Subquery")[0]
    assert "Exchange hashpartitioning" not in body and "BroadcastHashJoin" in body and "text" not in body
