import random

from corpuslab import workflows
from corpuslab.operators import models, topics

POSITIVE = "great lovely happy sunny sweet".split()
NEGATIVE = "awful nasty gloomy rotten bitter".split()


def test_sentiment(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        words = [rng.choice(POSITIVE if i % 2 else NEGATIVE) for _ in range(8)]
        rows.append((4 if i % 2 else 0, i, "@you " + " ".join(words) + " http://x.y"))
    rows += [(2, 900, "neither"), (None, 901, "no label"), (4, 902, None)]
    df = spark.createDataFrame(rows, "sentiment int, item_id long, sentiment_text string")
    settings = models.VectorSettings(dim=8, min_count=2, max_iter=5, seed=1)
    model = workflows.train_sentiment(df, settings=settings, min_df=2)
    result = model.accuracy.first()
    assert result["accuracy"] > 0.8 and 10 < result["n_rows"] < 90
    assert {r["word"] for r in model.idf.collect()} <= set(POSITIVE + NEGATIVE)


def test_authors(spark):
    rng = random.Random(2)
    voices = {"EAP": "raven midnight chamber dreary".split(), "HPL": "cosmic abyss elder horror".split(),
              "MWS": "glacier creature father sorrow".split()}

    def text(author):
        return ". ".join(" ".join(rng.choice(voices[author]) for _ in range(6)) for _ in range(3))

    train = [(f"t{i}{a}", text(a), a) for i in range(20) for a in voices]
    unseen = [(f"u{i}{a}", text(a)) for i in range(4) for a in voices]
    model = workflows.classify_authors(
        spark.createDataFrame(train, "id string, text string, author string"),
        spark.createDataFrame(unseen, "id string, text string"),
        topic_settings=topics.TopicSettings(k=3, passes=6, batch_share=0.5, seed=1),
        vector_settings=models.VectorSettings(dim=6, min_count=1, max_iter=3, seed=1),
        min_df=2, folds=2,
    )
    assert model.leaderboard.count() == 6
    out = model.submission.collect()
    assert model.submission.columns == ["id", "EAP", "HPL", "MWS"] and len(out) == len(unseen)
    right = sum(max(("EAP", "HPL", "MWS"), key=lambda a: r[a]) == r["id"][2:] for r in out)
    assert right >= 10 and all(abs(r["EAP"] + r["HPL"] + r["MWS"] - 1) < 1e-9 for r in out)


def test_intents_with_spelling(spark):
    table = spark.createDataFrame(
        [("open", [1.0, 0.0, 0.0]), ("account", [0.9, 0.1, 0.0]), ("lost", [0.0, 1.0, 0.0]), ("card", [0.0, 0.9, 0.2])],
        "word string, vector array<double>",
    )
    labelled = spark.createDataFrame(
        [(1, "I want to open an account", "accounts"), (2, "my card is lost", "cards"), (3, "lost my card", "cards"),
         (4, "zzz", "other")],
        "stored_id long, query string, intent string",
    )
    spelling = spark.createDataFrame([("open", 5), ("account", 4), ("lost", 3), ("card", 3), ("want", 9)], "word string, n long")
    index = workflows.build_intent_index(labelled, table, spelling)
    asked = spark.createDataFrame([(1, "opne acount"), (2, "LOST crad"), (3, "")], "query_id long, text string")
    got = {r["query_id"]: (r["intent"], r["stored_id"]) for r in index.answer(asked).collect()}
    assert got == {1: ("accounts", 1), 2: ("cards", 2)}  # equal rows: the lower id


def test_corpus_vectors_hold_merged_words(spark, tmp_path):
    sub = tmp_path / "texts" / "deep"
    sub.mkdir(parents=True)
    body = "Credit card limits apply. " * 12 + "Savings account rates vary daily. " * 3
    (sub / "a.txt").write_text("== Heading ==. " + body)
    (tmp_path / "texts" / "b.md").write_text("ignored words here. " * 20)
    table = workflows.corpus_word_vectors(spark, str(tmp_path / "texts"), threshold=0.1)
    words = {r["word"] for r in table.collect()}
    assert any("credit_card" in w for w in words) and "ignored" not in words
    assert len(table.first()["vector"]) == 3


def test_latent_index(spark):
    cells = [("d1", "claim", 0.4), ("d1", "deduct", 0.9), ("d2", "claim", 0.2), ("d2", "premium", 1.0),
             ("d3", "premium", 0.3), ("d3", "rate", 0.3), ("d4", "rate", 0.5), ("d4", "deduct", 0.0)]
    matrix = spark.createDataFrame(cells, "doc_id string, term string, value double")
    index = workflows.build_latent_index(matrix, k=4, share=1.0)
    ranked = index.search("what is deducted").collect()
    # at full rank the query is d1 - d2 + d3 - d4, so d1 and d3 tie
    scores = {r["doc_id"]: r["similarity"] for r in ranked}
    assert len(ranked) == 4 and ranked[-1]["similarity"] < 0
    assert abs(scores["d1"] - 0.5) < 1e-6 and abs(scores["d3"] - 0.5) < 1e-6


def test_latent_index_holds_every_word(spark):
    cells = [(f"d{d}", f"term{d}_{i}", 1.0) for d, n in enumerate((500, 350, 250, 100)) for i in range(n)]
    matrix = spark.createDataFrame([*cells, ("d3", "zebra", 1.0)], "doc_id string, term string, value double")
    index = workflows.build_latent_index(matrix, k=4, share=1.0)
    assert index.factors.words.count() == 1201
    first = index.search("zebra").first()
    assert first["doc_id"] == "d3" and abs(first["similarity"] - 1) < 1e-6
