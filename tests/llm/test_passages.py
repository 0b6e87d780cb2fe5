"""Quality by attention: descriptions and scores against plain loops, slopes, held-out labels, and the edge cases."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpuslab.llm import passages
from corpuslab.llm.queries import QUERIES

FAST = passages.Settings(rounds=60, words=16)


def corpus(n=240):
    rng = np.random.default_rng(5)
    plain = ["".join(rng.choice(list("abdeimnorstu"), rng.integers(2, 9))) for _ in range(400)]
    texts, good = [], []
    for i in range(n):
        words = list(rng.choice(plain, rng.integers(1, 200)))
        if i % 4 == 0:  # one stretch of the text is junk, the rest is not
            at = rng.integers(len(words))
            words[at:at] = [["$$$"] * 20, ["same"] * 25, [w.upper() for w in rng.choice(plain, 25)]][i % 3]
        texts.append(" ".join(words))
        good.append(i % 4 != 0)
    return texts, np.array(good)


def plain_passages(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [words[i : i + size] for i in range(0, len(words), size)] or [[]]


def test_descriptions_of_whole_texts():
    texts = ["", None, " \n ", "a", "One two, two two!\nA B c\n\nd", "x1 #y é " * 40, "w " * 20_000, "Long" * 5000]
    number, shares, bag = passages.describe(pa.array(texts, pa.string()), 16)
    assert list(number) == [len(plain_passages(t, 16)) for t in texts]
    assert (bag.sum(1) == [len(p) for t in texts for p in plain_passages(t, 16)]).all()
    row = 0
    for t in texts:
        for p in plain_passages(t, 16):
            joined = "".join(p).encode()
            solid, filled = max(1, len(joined)), max(1, len(p))
            assert shares[row][0] == pytest.approx(np.log1p(len(p)))
            assert shares[row][1] == pytest.approx(len(joined) / filled)
            assert shares[row][2] == pytest.approx(sum(65 <= c <= 90 for c in joined) / solid)
            assert shares[row][8] == pytest.approx(sum(c > 127 for c in joined) / solid)
            assert shares[row][10] == pytest.approx(len(set(p)) / filled)
            row += 1
    stretches, again = [], 0
    words = re.findall(r"\S+", texts[5])
    for i in range(len(words) - 2):
        again += words[i : i + 3] in stretches
        stretches.append(words[i : i + 3])
    at = int(number[:5].sum())
    assert sum(s[11] * max(1, b.sum()) for s, b in zip(shares[at:], bag[at : at + number[5]])) == pytest.approx(again)


def test_scores_as_in_plain_loops():
    texts, good = corpus(60)
    model = passages.fit(*passages.describe(pa.array(texts), 16), good, FAST)
    w = {k: v.astype(float) for k, v in model.weights.items()}
    got = passages.score_texts(pa.array(texts + [None]), model)
    for text, value in zip(texts + [""], got):
        _, shares, bag = passages.describe(pa.array([text]), 16)
        pulls, vectors = [], []
        for s, b in zip(shares, bag):
            x = np.concatenate([np.clip((s - model.centre) / model.scale, -4, 4), np.sqrt(b / max(1, b.sum()))])
            h = np.tanh(x @ w["encode"] + w["encode_b"])
            vectors.append(h)
            pulls.append(np.exp((np.tanh(h @ w["tone"]) / (1 + np.exp(-(h @ w["gate"])))) @ w["pull"]))
        z = sum(p * v for p, v in zip(pulls, vectors)) / sum(pulls)
        assert value == pytest.approx(1 / (1 + np.exp(-(z @ w["score"] + w["score_b"][0]))), abs=1e-4)


def test_slopes_are_those_of_the_loss():
    texts, good = corpus(24)
    number, shares, bag = passages.describe(pa.array(texts), 16)
    x = passages._inputs(shares, bag, shares.mean(0), shares.std(0) + 1e-3).astype(float)
    rng = np.random.default_rng(1)
    w = {k: rng.standard_normal(v.shape) * 0.3 for k, v in passages.fit(number, shares, bag, good, FAST).weights.items()}
    share = np.full(len(good), 1 / len(good))

    def loss():
        p = passages._sigmoid(passages._forward(x, number, w)["odds"])
        return -(share * np.where(good, np.log(p), np.log(1 - p))).sum()

    slopes = passages._gradients(x, number, good.astype(float), share, w)
    for k, v in w.items():
        for _ in range(4):
            at = tuple(rng.integers(n) for n in v.shape)
            v[at] += 1e-5
            up = loss()
            v[at] -= 2e-5
            down = loss()
            v[at] += 1e-5
            assert slopes[k][at] == pytest.approx((up - down) / 2e-5, rel=1e-2, abs=1e-6)


def test_one_bad_passage_is_found_and_pulls_most():
    texts, good = corpus()
    model = passages.fit(*passages.describe(pa.array(texts[:160]), 16), good[:160], FAST)
    said = passages.score_texts(pa.array(texts[160:]), model) >= 0.5
    assert (said == good[160:]).mean() > 0.93
    again = passages.fit(*passages.describe(pa.array(texts[:160]), 16), good[:160], FAST)
    assert all(np.array_equal(again.weights[k], v) for k, v in model.weights.items())


def test_held_out_rows_of_the_test_table(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op13_quality_classifier"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(out) == 1000 and out["score"].between(0, 1).all()
    assert (out["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in out["doc_id"]]).all()
    assert (out["predicted"] == (out["score"] >= 0.3)).all()
    both = out[out["held_out"]].merge(labels, on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.9


def test_held_out_labels_change_nothing(spark):
    texts, good = corpus(40)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, good string")
    labels = spark.createDataFrame([(i, bool(g)) for i, g in enumerate(good)], "doc_id long, good boolean")
    a = passages.train(docs, labels.filter("doc_id % 5 <> 0"), FAST)
    b = passages.train(docs.filter("doc_id % 5 <> 0"), labels, FAST)
    assert all(np.array_equal(a.weights[k], b.weights[k]) for k in a.weights)


def test_edge_cases(spark):
    rows = [(1, "x y", 1), (2, None, 0), (None, "bad", None), (4, "", 0), (4, "...", 0), (5, "bad " * 90_000, 1), (1, "x y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    schema = "doc_id long, good boolean"
    labels = spark.createDataFrame([(1, True), (5, False), (2, True), (4, None), (None, True), (9, True)], schema)
    got = passages.score(docs, passages.train(docs, labels, FAST)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    for few, least, most in ([], 0.4, 0.6), ([(1, True)], 0.9, 1), ([(1, False)], 0, 0.1):
        model = passages.train(docs, spark.createDataFrame(few, schema), FAST)
        assert all(least <= r.score <= most for r in passages.score(docs, model).collect())
    assert passages.score(docs.limit(0), model).count() == 0
