"""Each stage on the rows that the one before kept, and the whole run."""

import re

import pyarrow as pa
import pytest

import corpus_pipeline
from corpuslab.llm import pii, quality, store
import test_decontam
import test_minhash
import test_pii
import test_tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(rows before, rows after) of every stage of one whole run."""
    seen, keep = [spark.read.parquet(f"{SF}/documents.parquet")], store.keep

    def watched(df, name):
        seen.append(keep(df, name))
        return seen[-1]

    corpus_pipeline.store.keep = watched
    try:
        seen.append(corpus_pipeline.run(spark, SF))
    finally:
        corpus_pipeline.store.keep = keep
    return {name: (a, b) for (name, _), a, b in zip(corpus_pipeline.STAGES, seen[:-1], seen[1:], strict=True)}


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_return_documents(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.dtypes == columns, name


def test_quality(stages):
    before, after = stages["quality_rules"]
    verdicts = {r.doc_id: r.kept for r in quality.judge(before).select("doc_id", "q.kept").collect()}
    assert set(texts(after)) == {d for d, k in verdicts.items() if k} != set(verdicts)


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert set(texts(after)) == {c for _, c in test_minhash.classes_by_hand(rows)}


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    items = [test_decontam.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    pairs = [set(zip(x, x[1:], strict=False)) for x in items]
    clean = set()
    for d, t in texts(before).items():
        w = test_decontam.words(t)
        mine = set(zip(w, w[1:], strict=False))
        if not any(mine & p and test_decontam.brute_force(w, x) for x, p in zip(items, pairs, strict=True)):
            clean.add(d)
    assert set(texts(after)) == clean


def test_personal_data(stages):
    before, after = (texts(x) for x in stages["personal_data"])
    assert set(before) == set(after)
    for d, t in before.items():
        assert after[d] == pii.mask_text(t, test_pii.plain(t))
        assert not re.search(r"[a-z0-9]@mail", after[d])
    assert any(before[d] != after[d] for d in before)


def test_packing_holds_every_document(stages):
    before, after = stages["best_fit_packing"]
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(texts(before))
    test_tokens.check_packing(rows, 2048)


def test_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(f"the word{i} likes{i} of" for i in range(40))
    rows = [(1, good, None, None, None), (None, good + " more", "en", "s", 3), (2, None, None, "s", 0), (1, good, None, None, None)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        some = docs.count() > 0
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert (docs.count() > 0) == some, name


def test_python_gets_batches_of_bounded_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    had = spark.conf.get(key)
    row = "doc_id", "repeat('stone ', 1600) AS text"
    docs = spark.range(0, 3000, 1, 1).withColumnRenamed("id", "doc_id").selectExpr(*row)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"bytes": pa.array([batch.nbytes])})

    try:
        for name, stage in corpus_pipeline.STAGES[1:]:
            spark.conf.set(key, "64m")
            stage(spark, docs.limit(3), SF)
            seen = docs.mapInArrow(sizes, "bytes long").agg({"bytes": "max"}).first()[0]
            assert seen <= store.BATCH_BYTES + 2 * 9600, name
    finally:
        spark.conf.set(key, had)
