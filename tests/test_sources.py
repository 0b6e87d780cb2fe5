from pyspark.ml import Pipeline
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.feature import CountVectorizer, Word2Vec
from pyspark.sql import functions as F

from corpuslab.sources import readers, writers


def test_messages_without_header(spark, tmp_path):
    (tmp_path / "m.csv").write_text('4,1,Mon,Q,bob,"Hi, all"\n0,2,Tue,Q,eve,\n,3,Wed,Q,joe,hey\n')
    rows = readers.read_messages(spark, str(tmp_path / "m.csv")).orderBy("item_id").collect()
    assert [r["sentiment"] for r in rows] == [4, 0, None]
    assert [r["sentiment_text"] for r in rows] == ["Hi, all", None, "hey"]


def test_headlines_skip_malformed_lines(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "publish_date,headline_text\n20030219,rain over town\n20030220,too,many,fields\n20030221,dry again\n"
    )
    got = readers.read_headlines(spark, str(tmp_path / "h.csv"))
    assert got.count() == 2
    assert sorted(r[0] for r in got.collect()) == ["dry again", "rain over town"]


def test_documents_with_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "d.csv").write_text('id,text,author\na1,"one\ntwo ""x""",EAP\n')
    row = readers.read_documents(spark, str(tmp_path / "d.csv")).first()
    assert (row["id"], row["text"], row["author"]) == ("a1", 'one\ntwo "x"', "EAP")


def test_term_matrix_header_is_vocabulary(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,claim,what.is\nq1,0.5,0\nq2,0,2\n")
    got = {(r["doc_id"], r["term"]): r["value"] for r in readers.read_term_matrix(spark, str(tmp_path / "t.csv")).collect()}
    assert got == {("q1", "claim"): 0.5, ("q2", "what.is"): 2.0}


def test_utterances_and_topics(spark, tmp_path):
    (tmp_path / "u.csv").write_text("Query,X,Y,Intent\nopen account,1,2,accounts\n")
    assert readers.read_utterances(spark, str(tmp_path / "u.csv")).first() == ("open account", "accounts")
    (tmp_path / "t.csv").write_text("Working Concepts,Traverse_links\nBanking,True\nLoan,False\n")
    assert [tuple(r) for r in readers.read_topics(spark, str(tmp_path / "t.csv")).orderBy("topic").collect()] == [
        ("Banking", True), ("Loan", False)
    ]


def test_text_tree_lines_and_count(spark, tmp_path):
    sub = tmp_path / "corpus" / "deep"
    sub.mkdir(parents=True)
    (tmp_path / "corpus" / "a.txt").write_text("One.\nTwo.")
    (sub / "b.txt").write_text("Three.")
    (sub / "c.md").write_text("no")
    tree = readers.read_text_tree(spark, str(tmp_path / "corpus")).collect()
    assert sorted(r["content"] for r in tree) == ["One.\nTwo.", "Three."]
    assert readers.count_files(spark, str(tmp_path / "corpus")) == 3
    assert sorted(r["line"] for r in readers.read_text_lines(spark, str(sub)).collect()) == ["Three.", "no"]


def test_word_vectors(spark, tmp_path):
    (tmp_path / "v.txt").write_text("king 0.5 -1 2e-1\nqueen 1 2 3\n")
    got = {r["word"]: r["vector"] for r in readers.read_word_vectors(spark, str(tmp_path / "v.txt")).collect()}
    assert got == {"king": [0.5, -1.0, 0.2], "queen": [1.0, 2.0, 3.0]}


def test_csv_and_vectors_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.1, 0.2])], "id long, vector array<double>")
    writers.write_vectors(df, str(tmp_path / "v"))
    assert readers.read_vectors(spark, str(tmp_path / "v")).collect() == df.collect()
    writers.write_csv(df.select("id"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id"]


def test_quotes_are_appended(spark, tmp_path):
    quotes = spark.createDataFrame([("S&P", "4,000")], "name string, price string")
    for _ in range(2):
        writers.append_quotes(quotes, str(tmp_path / "q"))
    rows = spark.read.csv(str(tmp_path / "q")).collect()
    assert len(rows) == 2 and all(r[0] == "S&P" and r[2] for r in rows)


def test_vocabulary_and_articles(spark, tmp_path):
    vocab = spark.createDataFrame([("new_york", 700)], "token string, n long")
    writers.write_vocab_text(vocab, str(tmp_path / "vocab"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "vocab")).collect()] == ["new_york"]
    articles = spark.createDataFrame([("C++ (language)", "body"), ("Loan", "text")], "title string, content string")
    writers.write_articles(articles, str(tmp_path / "articles"), buckets=4)
    got = {r["name"]: r["content"] for r in spark.read.parquet(str(tmp_path / "articles")).collect()}
    assert got == {"--C language--": "body", "--Loan--": "text"}
    linked = spark.range(1).select(writers.article_name(F.lit("Loan!"), F.lit("Home loan (US)"))).first()[0]
    assert linked == "Loan_HomeloanUS"


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(["a", "b", "a"],), (["b", "c"],)], "words array<string>")
    model = Pipeline(stages=[CountVectorizer(inputCol="words", outputCol="f")]).fit(df)
    writers.save_model(model, str(tmp_path / "m"))
    assert readers.load_model(str(tmp_path / "m")).transform(df).first()["f"] == model.transform(df).first()["f"]
    counted = model.transform(df)
    for name, fitted in (
        ("lda", LDA(featuresCol="f", k=2, seed=1, maxIter=1).fit(counted)),
        ("kmeans", KMeans(featuresCol="f", k=2, seed=1).fit(counted)),
        ("vectors", Word2Vec(inputCol="words", outputCol="v", vectorSize=2, minCount=1, seed=1).fit(df)),
    ):
        writers.save_model(fitted, str(tmp_path / name))
        assert type(readers.load_model(str(tmp_path / name))) is type(fitted)


def test_literal_corpus(spark):
    titles = [
        "Rate limits for lending desk software", "A study of client views on desk response",
        "The client ledger entry screen", "Ledger and desk audits in practice",
        "Client wait and measured delay", "The growth of random sorted heaps",
        "Crossing paths in heaps", "Heap minors and narrow bounds", "Heap minors a study",
    ]
    corpus = readers.literal_corpus(spark, titles)
    assert corpus.count() == 9 and corpus.filter("doc_id = 8").first()["text"] == titles[8]
