"""Toxicity: held-out accuracy, unseen spellings, and the edge cases."""

import zlib

import numpy as np
import pyarrow as pa

from corpuslab.llm import toxicity
from corpuslab.llm.queries import QUERIES

FAST = toxicity.Settings(most_rows=400, buckets_log2=16, rounds=30)


def corpus(n=300):
    rng = np.random.default_rng(3)
    common = ["".join(rng.choice(list("abdeimnorstu"), rng.integers(2, 9))) for _ in range(400)]
    texts, marks = [], []
    for i in range(n):
        words = list(rng.choice(common, rng.integers(5, 60)))
        if i % 3 == 0:
            for _ in range(rng.integers(1, 4)):
                words[rng.integers(len(words))] = "vlogk" + rng.choice(["a", "en", "ita", "osso", "um", "e", "as", "i"])
        texts.append(" ".join(words))
        marks.append(i % 3 == 0)
    return texts, np.array(marks)


def test_unseen_spellings_are_caught():
    texts, marks = corpus()
    model = toxicity.fit(texts[:200], marks[:200], FAST)
    more = texts[200:] + ["some words and vlogkuuz here", "SOME WORDS AND VLOGKUUZ HERE"]
    scores = toxicity.score_texts(pa.array([t.lower() for t in more]), model.gram_scores(),
                                  float(model.bias[1] - model.bias[0]), FAST)
    said = scores >= 0.5
    assert (said[:100] == marks[200:]).mean() > 0.97 and said[100:].all()
    assert scores.min() >= 0 and scores.max() <= 1


def test_fit_is_repeatable():
    texts, marks = corpus(60)
    a, b = (toxicity.fit(texts, marks, FAST) for _ in range(2))
    assert np.array_equal(a.gram_scores(), b.gram_scores())


def test_held_out_rows_of_the_test_table(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op7_toxicity"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(out) == 1000 and out["score"].between(0, 1).all()
    assert (out["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in out["doc_id"]]).all()
    assert (out["predicted"] == (out["score"] >= 0.7)).all()
    both = out[out["held_out"]].merge(labels, on="doc_id")
    toxic, clean = both[both["toxic"] == 1]["score"], both[both["toxic"] == 0]["score"]
    higher = (toxic.to_numpy()[:, None] > clean.to_numpy()[None, :]).mean()
    assert higher > 0.8  # learnt from 34 toxic texts only


def test_edge_cases(spark):
    rows = [(1, "x y", 1), (2, None, 0), (None, "vlogk", None), (4, "", 0), (4, "...", 0), (5, "bad " * 90_000, 1), (5, "x y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labelled = spark.createDataFrame([(1, "bad word", 1, 0), (2, "good word", 0, 0), (3, None, 1, 0), (4, "x", None, 0)],
                                     "key long, text string, toxic int, lang int")
    model = toxicity.train(labelled, FAST)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    scores = sorted((r.score for r in got if r.doc_id == 4))
    assert scores == [0, 0]
    assert len({r.score for r in got if r.doc_id == 1} | {r.score for r in got if r.doc_id == 5}) == 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.train(spark.createDataFrame([], "key long, text string, toxic int"), FAST)
    assert all(r.score < 0.5 for r in toxicity.score(docs, none).collect())
