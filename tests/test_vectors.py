import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslab.functions import vectors as vx
from corpuslab.operators import latent, lexical, ordering, pivot_tree, similarity, stats, tables, vectors, weights


@pytest.fixture(scope="module")
def table(spark):
    rows = [("a", [1.0, 0.0, 0.0]), ("b", [0.0, 2.0, 0.0]), ("z", [0.0, 0.0, 0.0])]
    return spark.createDataFrame(rows, "word string, vector array<double>")


def test_mean_word_vectors(spark, table):
    rows = spark.createDataFrame(
        [(1, ["a", "b", "b", "x"]), (2, ["x"]), (3, [])], "doc_id long, words array<string>"
    )
    got = {r["doc_id"]: (r["known"], r["total"], r["vector"]) for r in vectors.mean_word_vectors(rows, table, 3).collect()}
    assert got[1][:2] == (3, 4)
    assert got[1][2] == pytest.approx([1 / 3, 4 / 3, 0.0])
    assert got[2] == (0, 1, [0.0, 0.0, 0.0])
    assert got[3] == (0, 0, [0.0, 0.0, 0.0])


def test_weighted_mean_divides_by_words_not_weights(spark, table):
    rows = spark.createDataFrame([(1, ["a", "b", "z"])], "doc_id long, words array<string>")
    idf = spark.createDataFrame([("a", 2.0), ("b", 3.0)], "word string, idf double")
    got = vectors.weighted_word_vectors(rows, table, idf, 3).first()
    assert got["known"] == 2
    assert got["vector"] == pytest.approx([1.0, 3.0, 0.0])


def test_standardize_uses_population_deviation(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 5.0], "A"), (2, [3.0, 5.0], "A"), (3, [9.0, 9.0], "B")], "id long, vector array<double>, s string"
    )
    got = {r["id"]: r["vector"] for r in vectors.standardize(df, 2, train=F.col("s") == "A").collect()}
    assert got[1] == pytest.approx([-1.0, 0.0]) and got[2] == pytest.approx([1.0, 0.0])
    assert got[3] == pytest.approx([7.0, 0.0])
    own = {r["id"]: r["vector"] for r in vectors.standardize(df, 2, per_split="s").collect()}
    assert own[3] == pytest.approx([0.0, 0.0])


def test_cosine_of_zero_vector_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(vx.cosine(F.col("a"), F.col("b"))).first()[0] is None


def _random_vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    return [(i, [float(x) for x in centres[i % 4] + 0.6 * rng.normal(size=dim)]) for i in range(n)]


def _cos(a, b):
    return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))


# (rows of a leaf, bytes sent whole, queries sent whole): whole tables, few queries, trees of several depths
WAYS = [(1000, None, 0), (1000, 0, 4096), (1000, 0, 0), (20, 0, 0), (5, 0, 0), (2, 0, 0)]


@pytest.mark.parametrize("block,whole,few", WAYS)
def test_nearest_rows_equals_brute_force(spark, monkeypatch, block, whole, few):
    monkeypatch.setattr(similarity, "FEW_QUERIES", few)
    monkeypatch.setattr(pivot_tree, "FAN_OUT", 4)
    monkeypatch.setattr(pivot_tree, "CHUNK_ROWS", 10)
    stored = _random_vectors(60, 5, 1)
    stored += [(100 + i, stored[3][1]) for i in range(30)]  # copies
    stored.append((999, [0.0] * 5))
    asked = _random_vectors(17, 5, 2) + [(500, [0.0] * 5)]
    q = spark.createDataFrame(asked, "query_id long, vector array<double>")
    s = spark.createDataFrame(stored, "stored_id long, vector array<double>")
    got = {}
    for r in similarity.nearest_rows(q, s, 3, block_rows=block, whole_bytes=whole).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["stored_id"], round(r["similarity"], 6)))
    distinct = {}
    for i, v in stored:
        if any(v):
            distinct.setdefault(tuple(v), i)
    for i, v in asked:
        if not any(v):
            assert i not in got
            continue
        best = sorted(((-round(_cos(v, w), 9), j) for w, j in distinct.items()))[:3]
        assert sorted(got[i]) == [(n, j, round(-c, 6)) for n, (c, j) in enumerate(best, start=1)]


@pytest.mark.parametrize("threshold,block,whole", [(0.9, 8, 0), (0.5, 16, 0), (0.2, 1000, 0), (0.5, 16, None), (-1, 4, 0)])
def test_similar_pairs_equals_brute_force(spark, monkeypatch, threshold, block, whole):
    monkeypatch.setattr(pivot_tree, "FAN_OUT", 4)
    rows = _random_vectors(90, 6, 3)
    rows += [(200 + i, rows[5][1]) for i in range(45)]  # a third are copies of one row
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = {
        (r["a"], r["b"]): (round(r["similarity"], 6), r["copies_a"], r["copies_b"])
        for r in similarity.similar_pairs(df, threshold, block_rows=block, whole_bytes=whole).collect()
    }
    want = {}
    for i, (a, v) in enumerate(rows[:90]):
        for b, w in rows[i + 1:90]:
            c = round(_cos(v, w), 9)
            if c >= threshold:
                want[(a, b)] = (round(c, 6), 46 if a == 5 else 1, 46 if b == 5 else 1)
    assert got == want


def test_tree_leaves_out_what_cannot_match(spark, monkeypatch):
    """Rows in tight groups: a query is sent to few leaves, and rows per query stay flat when rows double."""
    monkeypatch.setattr(pivot_tree, "CHUNK_ROWS", 500)
    rng = np.random.default_rng(8)
    visits = []
    for n in (600, 1200):
        centres = rng.normal(size=(n // 30, 16))
        rows = [(i, [float(x) for x in centres[i % len(centres)] + 0.02 * rng.normal(size=16)]) for i in range(n)]
        df = spark.createDataFrame(rows, "stored_id long, vector array<double>")
        index = similarity.build_index(df, block_rows=40, whole_bytes=0)
        asked = index.rows.select("id", "vector", F.lit(0.2).alias("bound"), F.lit("").alias("node"))
        reached = pivot_tree._descend(index.tree, asked, greedy=False)
        visits.append(reached.count() / n)
        assert index.tree.rows.groupBy("node").count().agg(F.max("count")).first()[0] <= 40
        assert index.tree.rows.count() == n
    assert max(visits) < 4 and visits[1] < visits[0] * 1.3


def test_tree_of_rows_that_lie_evenly(spark, monkeypatch):
    """Vectors at equal angles cannot be told apart by pivots; the tree still ends and finds all."""
    monkeypatch.setattr(pivot_tree, "FAN_OUT", 3)
    monkeypatch.setattr(pivot_tree, "MOST_LEVELS", 2)
    rows = [(i, [float(i == j) for j in range(40)]) for i in range(40)]
    df = spark.createDataFrame(rows, "stored_id long, vector array<double>")
    got = similarity.nearest_rows(df.withColumnRenamed("stored_id", "query_id"), df, 2, block_rows=2, whole_bytes=0).collect()
    want = {(i, r): j for i in range(40) for r, j in ((1, i), (2, 1 if i == 0 else 0))}
    assert {(r.query_id, r["rank"]): r.stored_id for r in got} == want


def test_stored_index_has_versions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(similarity, "FEW_QUERIES", 0)
    rows = _random_vectors(50, 4, 6)
    df = spark.createDataFrame(rows, "stored_id long, vector array<double>")
    asked = df.limit(9).withColumnRenamed("stored_id", "query_id")
    path = str(tmp_path / "index")
    assert similarity.build_index(df, block_rows=6, whole_bytes=0).save(path) == 1
    more = df.unionByName(spark.createDataFrame([(77, rows[0][1])], df.schema))
    assert similarity.build_index(more.filter("stored_id <> 0")).save(path) == 2
    old, new = similarity.open_index(spark, path, 1), similarity.open_index(spark, path)
    assert old.tree is not None and new.tree is None and (old.n, new.n) == (50, 50)
    best = {r.query_id: r.stored_id for r in old.nearest(asked).collect()}
    assert best == {i: i for i in range(9)}
    assert {r.query_id: r.stored_id for r in new.nearest(asked).collect()} == {**best, 0: 77}
    with pytest.raises(ValueError):
        similarity.open_index(spark, path, 3)


def test_search_in_nothing(spark):
    df = spark.createDataFrame([], "stored_id string, vector array<double>")
    asked = spark.createDataFrame([("a", [1.0, 0.0])], "query_id string, vector array<double>")
    assert similarity.nearest_rows(asked, df).count() == 0
    assert similarity.similar_pairs(df, 0.5, key="stored_id").count() == 0
    words = spark.createDataFrame([("x", [1.0, 0.1]), ("y", [0.0, 1.0])], df.schema)
    assert [r.stored_id for r in similarity.nearest_rows(asked, words).collect()] == ["x"]


def test_nearest_words(spark):
    rows = [("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 1.0]), ("d", [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "word string, vector array<double>")
    assert [r["word"] for r in similarity.nearest_words(df, "a", 2).collect()] == ["b", "c"]


def test_dense_index_over_many_partitions(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, v % 3) for v in values], "v long, g long").repartition(13)
    got = {r["v"]: r["idx"] for r in ordering.dense_index(df, ["v"]).collect()}
    assert got == {v: v for v in range(500)}
    within = {r["v"]: r["i"] for r in ordering.index_within(df, "g", ["v"], "i").collect()}
    assert within == {v: v // 3 for v in range(500)}


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    one = {r["k"]: r["split"] for r in tables.holdout_split(df.coalesce(1), "k").collect()}
    two = {r["k"]: r["split"] for r in tables.holdout_split(df.repartition(7), "k").collect()}
    assert one == two
    assert 0.7 < sum(v == "TRAIN" for v in one.values()) / 300 < 0.9


def test_recode_leaves_other_values_null(spark):
    df = spark.createDataFrame([(0,), (2,), (4,)], "s int")
    assert [r[0] for r in df.select(tables.recode(F.col("s"), {4: 1, 0: 0})).collect()] == [0, None, 1]


def test_energy_rank(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 2.0), (3, 1.0)], "rank int, s double")
    assert stats.energy_rank(df, 0.85).first()["k"] == 2
    assert stats.energy_rank(df, 1.0).first()["k"] == 3


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "x double")
    got = {r["bin"]: r["n"] for r in stats.histogram(df, "x", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_bags_sum_to_vocabulary_tokens(spark):
    rows = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b", "c"])], "doc_id long, words array<string>")
    vocab = weights.word_ids(weights.vocabulary_bounds(rows, min_df=2), capped=False)
    bags = weights.bag_of_words(rows, vocab).collect()
    assert sum(r["n"] for r in bags) == 2 and {r["word_id"] for r in bags} == {0}


def test_tf_idf_against_formula(spark):
    rows = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b"])], "doc_id long, words array<string>")
    got = {(r["doc_id"], r["word"]): r["weight"] for r in weights.tf_idf_smooth(rows).collect()}
    a, b = 2 * (math.log(3 / 2) + 1), math.log(3 / 3) + 1
    assert got[(1, "a")] == pytest.approx(a / math.hypot(a, b))
    assert got[(2, "b")] == pytest.approx(1.0)
    log2 = {(r["doc_id"], r["word"]): r["weight"] for r in weights.tf_idf_log2(rows).collect()}
    assert log2 == {(1, "a"): pytest.approx(1.0)}


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_spelling_equals_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 7)))
    vocab = {word(): rng.randint(1, 9) for _ in range(30)}
    asked = {word() for _ in range(60)} | {"cccccccccccccccc"}
    got = {
        r["word"]: (r["correction"], r["distance"])
        for r in lexical.spell_candidates(
            spark.createDataFrame([(w,) for w in asked], "word string"),
            spark.createDataFrame(list(vocab.items()), "word string, n long"),
        ).collect()
    }
    want = {}
    for w in asked - set(vocab):
        near = sorted((_edits(w, v), -n, v) for v, n in vocab.items() if _edits(w, v) <= 2)
        if near:
            want[w] = (near[0][2], near[0][0])
    assert got == want


def test_lemmas(spark):
    words = spark.createDataFrame([(w,) for w in "cats cat men man boxes box flies fly glass".split()], "word string")
    got = {r["word"]: r["lemma"] for r in lexical.lemma_table(words).collect()}
    # "men" is in the lexicon itself and no candidate is shorter
    assert got == {"cats": "cat", "boxes": "box", "flies": "fly"}
    men = spark.createDataFrame([("firemen",), ("men",)], "word string")
    known = spark.createDataFrame([("fireman",), ("man",)], "w string")
    assert {r["word"]: r["lemma"] for r in lexical.lemma_table(men, known).collect()} == {
        "firemen": "fireman", "men": "man"
    }
    verbs = spark.createDataFrame([("running",), ("baked",)], "word string")
    lexicon = spark.createDataFrame([("run",), ("bake",)], "w string")
    assert {r["word"]: r["lemma"] for r in lexical.lemma_table(verbs, lexicon, "verb").collect()} == {"baked": "bake"}


def test_latent_factors_against_numpy(spark):
    names = ["w0", "w1", "w2", "w3"]
    matrix = np.array([[1, 1, 0, 0], [1, 0, 1, 0], [0, 1, 1, 0], [0, 0, 1, 1], [1, 1, 1, 1], [1, 0, 0, 0]], float)
    rows = spark.createDataFrame(
        [(i, [names[j] for j in np.nonzero(r)[0]]) for i, r in enumerate(matrix)], "doc_id long, words array<string>"
    )
    factors = latent.svd(rows, names, 3)
    u, s, _ = np.linalg.svd(matrix, full_matrices=False)
    values = [r["s"] for r in factors.values.orderBy("rank").collect()]
    assert values == pytest.approx(list(s[:3]), abs=1e-6)
    assert values == sorted(values, reverse=True)
    folded = latent.fold_in(latent.binary_weights(rows), factors.words, factors.values, factors.k)
    got = np.array([r["vector"] for r in folded.orderBy("doc_id").collect()])
    assert np.abs(got) == pytest.approx(np.abs(u[:, :3]), abs=1e-5)  # signs are free
    assert 1 <= latent.reduce_rank(factors).k <= factors.k
    scored = latent.lsi_query("w0 and w1", factors, folded, stem=False)
    best = scored.orderBy(F.desc("similarity")).first()
    assert best["doc_id"] == 0
    nothing = latent.lsi_query("unheard of", factors, folded).select("similarity").first()
    assert nothing[0] is None


def test_matrix_product(spark):
    a, b = np.arange(6.0).reshape(2, 3), np.arange(12.0).reshape(3, 4)
    as_rows = lambda m: spark.createDataFrame(
        [(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])], "i int, j int, value double"
    )
    for tile in (None, 3):
        got = np.zeros((2, 4))
        for r in latent.matrix_product(as_rows(a), as_rows(b), tile).collect():
            got[r["i"], r["j"]] = r["value"]
        assert np.allclose(got, a @ b)


def test_word_vectors_past_the_broadcast_are_sent_to_their_documents(spark, monkeypatch):
    """A table too large for the driver: same rows, and nothing of it is broadcast."""
    from corpuslab.operators import postings

    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    listed = [(i % 30 if i % 7 else None, [rng.choice(words) for _ in range(rng.randint(0, 25))]) for i in range(60)]
    rows = spark.createDataFrame([*listed, (99, []), (98, None)], "doc_id long, words array<string>")
    table = spark.createDataFrame([(w, [rng.gauss(0, 1) for _ in range(5)]) for w in [*words[:30], *words[:4]]] + [("w31", None), ("w1", None), ("w32", [1.0, None])],
                                  "word string, vector array<double>")
    idf = spark.createDataFrame([(w, rng.random()) for w in words[10:]], "word string, idf double")

    def said(bags):
        found = [vectors.mean_word_vectors(bags, table, 5), vectors.weighted_word_vectors(bags, table, idf, 5)]
        return found, [
            sorted((str(r.doc_id), r.known, r.total, [round(x, 9) + 0.0 for x in r.vector]) for r in df.collect()) for df in found
        ]

    both = (rows, postings.bags(rows))
    want = [said(bags)[1] for bags in both]
    monkeypatch.setattr(vectors, "WHOLE_BYTES", 0)
    monkeypatch.setattr(vectors, "GROUP_ROWS", 50)
    monkeypatch.setattr(vectors, "CELLS", 35)
    for bags, expected in zip(both, want):
        found, got = said(bags)
        assert got == expected
        assert "FlatMapCoGroupsInArrow" in found[0]._jdf.queryExecution().optimizedPlan().toString()


def test_matrix_product_of_many_pieces_sums_in_groups_of_rows(spark, monkeypatch):
    rng = random.Random(5)
    left = [(rng.choice([None, *range(12)]), f"k{rng.randrange(9)}", rng.gauss(0, 1)) for _ in range(150)]
    left += [(1, None, 1.0), (50, "k1", None), (51, "nowhere", 1.0)]
    right = [(f"k{rng.randrange(9)}", rng.randrange(11), rng.gauss(0, 1)) for _ in range(40)] + [(None, 1, 1.0), ("k2", 3, None)]
    a = spark.createDataFrame(left, "i long, j string, value double")
    b = spark.createDataFrame(right, "i string, j long, value double")

    def said(df):
        return sorted((str(r.i), r.j, round(r.value, 9) + 0.0) for r in df.collect())

    plain = latent.matrix_product(a, b).filter("value IS NOT NULL")
    want = said(plain)
    few = latent.matrix_product(a, b, tile=4)
    assert said(few) == want and "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(vectors, "WHOLE_BYTES", 0)
    monkeypatch.setattr(vectors, "GROUP_ROWS", 20)
    monkeypatch.setattr(vectors, "CELLS", 12)
    many = latent.matrix_product(a, b, tile=4)
    assert said(many) == want
    assert "FlatMapCoGroupsInArrow" in many._jdf.queryExecution().optimizedPlan().toString()
