"""Near-duplicate groups against exact similarity of all pairs; sampling against its expectation."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpuslab.llm import graph, minhash
from corpuslab.llm import hashing as hx

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return {}
    out = {}
    for i in range(max(1, len(words) - 4)):
        key = tuple(words[i : i + 5])
        out[key] = out.get(key, 0) + 1
    return out


def idf_by_hand(texts):
    n, df = len(texts), {}
    bucket = {}
    for t in texts:
        words = sorted(set(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
        if words:
            got = minhash._buckets(hx.Words(pa.array([" ".join(words)])).hashes())
            bucket.update(zip(words, got.tolist(), strict=True))
            for b in set(got.tolist()):
                df[b] = df.get(b, 0) + 1
    return {w: float(np.float32(1 + np.log((n + 1) / (df[b] + 1)))) for w, b in bucket.items()}


def classes_by_hand(rows, least=0.8, sharp=True):
    idf = idf_by_hand([t for _, t in rows])
    weighed = [
        {k: c * sum(idf[w] for w in k) / len(k) for k, c in shingles(t).items()} for _, t in rows
    ]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = {}
    for i, s in enumerate(weighed):
        for k in s:
            at.setdefault(k, []).append(i)
    pairs = {(a, b) for l in at.values() for a in l for b in l if a < b}
    close = []
    for a, b in pairs:
        x, y = weighed[a], weighed[b]
        both = sum(min(x[k], y[k]) for k in x.keys() & y.keys())
        s = both / (sum(x.values()) + sum(y.values()) - both)
        if sharp and abs(s - least) < 1e-3:
            close.append((a, b))
        if s >= least or (rows[a][1] or "") == (rows[b][1] or ""):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    for i, (_, t) in enumerate(rows):  # equal texts without a shingle
        for j in range(i):
            if (rows[j][1] or "") == (t or ""):
                parent[max(find(i), find(j))] = min(find(i), find(j))
                break
    assert not close
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    named = {r: min((d for d in ds if d is not None), default=None) for r, ds in groups.items()}
    return sorted(((rows[i][0], named[find(i)]) for i in range(len(rows))), key=repr)


def got(df, **how):
    out = minhash.duplicate_groups(df, **how)
    return sorted(((r.doc_id, r.class_id) for r in out.collect()), key=repr)


def corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"v{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    rows, no = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 160))]
        for _ in range(rng.randint(1, 12)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((no * 7 % 1009, " ".join(text)))
            no += 1
    chain = [f"c{i}" for i in range(120)]
    for i in range(8):  # each near the next, the ends far apart
        rows.append((2000 + i, " ".join(chain)))
        for _ in range(2):
            chain[rng.randrange(len(chain))] = f"n{i}{rng.random()}"
    return rows


def test_groups_equal_those_of_all_pairs(spark):
    rows = corpus() + [(3000, None), (3001, ""), (3002, " \n"), (3003, "one two"), (3004, "one  two"), (3003, "one two"),
                       (None, "a b c d e f g h"), (None, "a b c d e f g h"), (3005, "x y z a b c"), (2999, "x y z a b c")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class_id int").repartition(4)
    assert got(docs) == classes_by_hand(rows)
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted(((r.doc_id) for r in kept.collect()), key=repr)
    assert ids == sorted({c for _, c in classes_by_hand(rows) if c is not None} | {None}, key=repr)


def test_unlike_texts_with_one_doc_id_stay_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a), (5, b), (7, a), (8, b), (9, b + " end"), (5, c), (5, c), (None, c + " end")]
    rows += [(None, " ".join(f"n{i}" for i in range(40))), (None, " ".join(f"n{i}" for i in range(41)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id, r.text[0]) for r in minhash.keep_first(docs).collect()), key=repr)
    assert kept == [(5, "a"), (5, "b"), (5, "c"), (None, "n")]


def test_many_unlike_texts_in_one_bucket(spark):
    # bands of one sample: buckets hold texts that share little, hubs reach few of them
    rng = random.Random(1)
    lead = " ".join(f"lead{i}" for i in range(12))
    rows = [(i, f"{lead} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(10))) for i in range(80)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(0, 80, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(docs, s=minhash.Settings(bands=40, rows=1, agree=15, hubs=2, block=20)) == classes_by_hand(rows)


def copies_of_copies(n, words=90, seed=5, changes=(4, 9)):
    """One dense group: every text is a copy of an earlier one with some words changed."""
    rng = random.Random(seed)
    texts = [[f"b{i}" for i in range(words)]]
    for i in range(1, n):
        text = list(rng.choice(texts[: 1 + i // 3]))
        for _ in range(rng.randint(*changes)):
            text[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        texts.append(text)
    return [(i * 13 % 10007, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("changes", [(1, 3), (2, 5)])
def test_dense_group_of_copies_of_copies(spark, changes):
    """Groups from links between members of one bucket whose hubs are far from both."""
    rows = copies_of_copies(260, changes=changes)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = dict(got(docs, s=minhash.Settings(hubs=2, block=32)))
    # pairs a hair from the threshold may fall to either side
    fine, coarse = (dict(classes_by_hand(rows, least, sharp=False)) for least in (0.801, 0.799))
    assert len(set(coarse.values())) > 3
    assert len({(fine[d], found[d]) for d in fine}) == len(set(fine.values()))
    assert len({(found[d], coarse[d]) for d in fine}) == len(set(found.values()))


def test_what_moves_grows_with_the_members_of_a_group(spark, monkeypatch):
    tables, made = {}, minhash.keep
    def counted(df, name, *more):
        out = made(df, name, *more)
        tables[name] = tables.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(minhash, "keep", counted)
    sizes = []
    for n in (200, 400, 800):
        tables.clear()
        rows = copies_of_copies(n, words=60, changes=(2, 4))
        minhash.duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).count()
        sizes.append({k: tables.get(k, 0) for k in ("near", "measured", "close", "joined")})
    for name in sizes[0]:
        for few, many in zip(sizes, sizes[1:]):
            assert many[name] <= 2.6 * few[name] + 50, sizes


def test_very_long_text_and_clashing_columns(spark):
    long = " ".join(f"w{i % 9973}" for i in range(60_000))
    names = ["__id", "__own", "__root", "place", "n", "____________place", "node", "samples"]
    rows = [(1, long, *names), (2, long + " end", *names), (3, "short text", *names), (3, "short text", *names)]
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in names)
    docs = spark.createDataFrame(rows, schema).repartition(3)
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_samples_agree_as_often_as_the_texts_are_alike():
    rng = np.random.default_rng(2)
    idf = (1 + rng.random(minhash.BUCKETS) * 5).astype(np.float32)
    base = [f"w{i}" for i in rng.integers(0, 5000, 300)]
    tables = minhash._tables(400)
    for changed in (4, 12, 40):
        other = list(base)
        for at in rng.integers(0, 300, changed):
            other[at] = "changed" + str(at)
        texts = [" ".join(base), " ".join(other)]
        words = hx.Words(pa.array(texts))
        a, b = minhash.signatures(*minhash.weighted_shingles(words, idf, 5), tables)
        exact = minhash.similarity(pa.array(texts[:1]), pa.array(texts[1:]), idf, 5)[0]
        assert abs((a == b).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / 400) + 0.01


@pytest.mark.parametrize("links,want", [
    ([], {}), ([(1, 2), (2, 3), (9, 8)], {1: 1, 2: 1, 3: 1, 9: 8, 8: 8}), ([(i, i + 1) for i in range(9)], dict.fromkeys(range(10), 0)),
    ([(5, 5)], {}), ([(0, i) for i in range(1, 9)] + [(9, 8)], dict.fromkeys(range(10), 0)),
])
def test_components(spark, links, want):
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.root for r in graph.components(df).collect()} == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.duplicate_groups(empty).count() == 0 and minhash.keep_first(empty).count() == 0


def test_members_of_a_bucket_are_packed_before_blocks_meet(spark, monkeypatch):
    """Blocks of a bucket are rows that meet; a member is not repeated for each block of the others."""
    rng = random.Random(8)
    shared = [f"s{i}" for i in range(60)]
    # alike enough to meet in a bucket, too different to be linked
    texts = [" ".join(shared + [f"w{rng.randrange(10**9)}" for _ in range(14)]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plans, keep = {}, minhash.keep
    monkeypatch.setattr(minhash, "keep", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and keep(df, name))
    few = minhash.duplicate_groups(docs, minhash.Settings(block=4, least=0.75)).collect()
    assert "MapInArrow" in plans["close"] and "explode(sequence" not in plans["close"]
    whole = minhash.duplicate_groups(docs, minhash.Settings(least=0.75)).collect()
    assert {(r.doc_id, r.class_id) for r in few} == {(r.doc_id, r.class_id) for r in whole}
