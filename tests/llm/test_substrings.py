"""Repeated passages against a direct reading of the definition."""

import hashlib
import re

import pytest

from corpuslab.llm.substrings import repeated_passages

SF = "/root/testdata/sf0.001"


def brute_force(rows, window=50):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    low = {}
    for (doc, _), ws in zip(rows, words, strict=True):
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            if doc is not None:
                low[key] = min(low.get(key, doc), doc)
    out = []
    for (doc, _), ws in zip(rows, words, strict=True):
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if doc is not None and low[tuple(ws[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        out.append((doc, len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    rows = [tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    return sorted(rows, key=repr)


def test_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_force(rows)
    assert any(r[2] for r in want)
    assert got(repeated_passages(docs)) == want


@pytest.mark.parametrize("window,stretch", [(5, 2), (6, 3), (4, 1)])
def test_small_windows_ties_nulls_and_repeats(spark, window, stretch):
    rows = [
        (5, "a b c d e f g h i j"), (3, "x a b c d e f y"), (3, "x a b c d e f y"), (9, None), (None, "a b c d e f g"),
        (7, ""), (8, "  \n\t "), (11, "a a a a a a a a a a a a"), (12, "q a a a a a a a r"), (2, "é ü\x0bñ ß ø å æ"),
        (4, "é ü ñ ß ø å æ"), (4, "other words with the same id g h i j k l m"), (1, "g h i j k l m"),
        (20, "a b c d e"), (21, "c d e f g"), (22, "a b c d e f g"), (23, "one"),
    ]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_words int").repartition(3)
    assert got(repeated_passages(docs, window, stretch)) == brute_force(rows, window)


def test_intervals_are_maximal(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "z a b c d y c d e f")], "doc_id long, text string")
    out = {r.doc_id: [tuple(i) for i in r.intervals] for r in repeated_passages(docs, 3, 1).collect()}
    assert out == {1: [], 2: [(1, 5), (6, 10)]}


def test_empty_table(spark):
    assert repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
