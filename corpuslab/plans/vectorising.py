"""Document vectors, similarity, intents, spelling (survey D, E10, E15-E17, J12, J30-J32)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.operators import latent, lexical, similarity, stats, tables, tokens, vectors, weights
from corpuslab.plans import data
from corpuslab.plans.registry import query
from corpuslab.plans.sqlparts import STOPS, lemma_parts, parts
from corpuslab.plans.tables import SPLIT
from corpuslab.session import cut_lineage
from corpuslab.sources.readers import read_table

WIDTH = 64
IDF = "idf AS (SELECT word, ln((1.0 + n_docs) / (1.0 + df)) + 1.0 AS idf FROM freq, nd WHERE df >= 10)"


@query("word_vector_lookup", parts("post", "wv") + "SELECT doc_id, word, n, vec_id FROM post JOIN wv USING (word)")
def word_vector_lookup(spark, sf):
    rows = data.bags(spark, sf)
    table = data.word_vectors(spark, sf, rows).select("word", "vec_id")
    return vectors.word_vector_lookup(rows, table)


def _idf(rows):
    return weights.smooth_idf(weights.vocabulary_bounds(rows, min_df=10), weights.document_count(rows))


@query(
    "vector_and_weight_lookup",
    parts("post", "wv", "nd", extra=IDF)
    + "SELECT doc_id, word, n, vec_id, round(idf, 6) AS idf FROM post JOIN wv USING (word) JOIN idf USING (word)",
)
def vector_and_weight_lookup(spark, sf):
    rows = data.bags(spark, sf)
    table = data.word_vectors(spark, sf, rows).select("word", "vec_id")
    return vectors.vector_and_weight_lookup(rows, table, _idf(rows)).withColumn("idf", F.round("idf", 6))


def document_vectors(spark, sf):
    rows = data.bags(spark, sf)
    return vectors.mean_word_vectors(rows, data.word_vectors(spark, sf, rows), WIDTH)


@query("mean_word_vector", parts("docvec") + "SELECT doc_id, dim, round(value, 6) AS value FROM docvec")
def mean_word_vector(spark, sf):
    return vectors.explode_vector(document_vectors(spark, sf), "doc_id")


_WEIGHTED = """wk AS (SELECT d.doc_id, coalesce(sum(CASE WHEN wv.word IS NOT NULL AND i.word IS NOT NULL THEN p.n END), 0) AS k
                 FROM documents d LEFT JOIN post p ON p.doc_id = d.doc_id LEFT JOIN wv ON wv.word = p.word
                 LEFT JOIN idf i ON i.word = p.word GROUP BY d.doc_id),
    ws AS (SELECT p.doc_id, w.dim, sum(p.n * i.idf * w.v) AS t FROM post p JOIN wv_long w USING (word)
                 JOIN idf i USING (word) GROUP BY p.doc_id, w.dim),
    wvec AS (SELECT wk.doc_id, dims.dim, coalesce(ws.t / nullif(wk.k, 0), 0.0) AS value
             FROM wk CROSS JOIN dims LEFT JOIN ws ON ws.doc_id = wk.doc_id AND ws.dim = dims.dim)"""


@query(
    "weighted_word_vector",
    parts("post", "wv_long", "nd", "dims", extra=IDF + ",\n" + _WEIGHTED)
    + "SELECT doc_id, dim, round(value, 6) AS value FROM wvec",
)
def weighted_word_vector(spark, sf):
    return vectors.explode_vector(weighted_vectors(spark, sf), "doc_id")


def weighted_vectors(spark, sf):
    rows = data.bags(spark, sf)
    return vectors.weighted_word_vectors(rows, data.word_vectors(spark, sf, rows), _idf(rows), WIDTH)


@query(
    "known_word_ratio",
    parts("known")
    + """SELECT doc_id, CAST(known AS BIGINT) AS known, CAST(total AS BIGINT) AS total,
                round(known / nullif(total, 0), 6) AS ratio FROM known WHERE total > 0""",
)
def known_word_ratio(spark, sf):
    rows = document_vectors(spark, sf).filter("total > 0")
    return rows.select("doc_id", "known", "total", F.round(F.col("known") / F.col("total"), 6).alias("ratio"))


@query(
    "mean_vector_by_author",
    parts("docvec")
    + """SELECT lang AS author, dim, round(avg(value), 6) AS value
         FROM docvec JOIN documents USING (doc_id) GROUP BY lang, dim""",
)
def mean_vector_by_author(spark, sf):
    authors = read_table(spark, sf, "documents").select("doc_id", F.col("lang").alias("author"))
    rows = document_vectors(spark, sf).join(authors, "doc_id")
    return vectors.explode_vector(vectors.mean_vector_by(rows, "author", WIDTH), "author")


_STATS = f"""sv AS (SELECT doc_id, dim, value, {SPLIT} AS split FROM docvec)"""


@query(
    "standardize",
    parts("docvec", extra=_STATS)
    + """, m AS (SELECT dim, avg(value) AS mu, stddev_pop(value) AS sd FROM sv WHERE split = 'TRAIN' GROUP BY dim)
         SELECT doc_id, dim, round(CASE WHEN sd > 0 THEN (value - mu) / sd ELSE 0.0 END, 5) AS value
         FROM sv JOIN m USING (dim)""",
)
def standardize(spark, sf):
    """Training rows' mean and deviation, applied to all rows."""
    rows = tables.holdout_split(document_vectors(spark, sf), "doc_id")
    scaled = vectors.standardize(rows, WIDTH, train=F.col("split") == "TRAIN")
    return vectors.explode_vector(scaled, "doc_id", digits=5)


@query(
    "standardize_per_split",
    parts("docvec", extra=_STATS)
    + """, m AS (SELECT split, dim, avg(value) AS mu, stddev_pop(value) AS sd FROM sv GROUP BY split, dim)
         SELECT doc_id, dim, round(CASE WHEN sd > 0 THEN (value - mu) / sd ELSE 0.0 END, 5) AS value
         FROM sv JOIN m USING (split, dim)""",
)
def standardize_per_split(spark, sf):
    """Each split on its own mean and deviation."""
    rows = tables.holdout_split(document_vectors(spark, sf), "doc_id")
    return vectors.explode_vector(vectors.standardize(rows, WIDTH, per_split="split"), "doc_id", digits=5)


@query(
    "matrix_product",
    parts("post", "wv_long")
    + """SELECT doc_id AS i, dim AS j, round(sum(n * v), 6) AS value
         FROM post JOIN wv_long USING (word) GROUP BY doc_id, dim""",
)
def matrix_product(spark, sf):
    """Document x word counts times word x dimension vectors."""
    rows = data.bags(spark, sf)
    a = weights.postings(rows).select(F.col("doc_id").alias("i"), F.col("word").alias("j"), F.col("n").alias("value"))
    table = data.word_vectors(spark, sf, rows)
    b = table.select(F.col("word").alias("i"), F.posexplode("vector").alias("j", "value"))
    return latent.matrix_product(a, b, tile=WIDTH).withColumn("value", F.round("value", 6))


NEAR_WORD = "the"
UTTERANCE = "Nicht aulich der that with erener and the le tion"


@query(
    "nearest_words",
    parts("tok", extra="""lf AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(words) AS word
             FROM lettered) GROUP BY word),
         lv AS (SELECT word, CAST(embedding AS DOUBLE[]) AS vector FROM (
             SELECT word, row_number() OVER (ORDER BY df DESC, word) - 1 AS r FROM lf) JOIN embeddings ON vec_id = r)""")
    + f"""SELECT a.word, round(list_cosine_similarity(a.vector, q.vector), 6) AS similarity
          FROM lv a, (SELECT vector FROM lv WHERE word = '{NEAR_WORD}') q WHERE a.word <> '{NEAR_WORD}'
          ORDER BY list_cosine_similarity(a.vector, q.vector) DESC, a.word LIMIT 10""",
)
def nearest_words(spark, sf):
    rows = tokens.document_words(data.documents(spark, sf), stops=None)
    table = data.word_vectors(spark, sf, rows)
    return similarity.nearest_words(table, NEAR_WORD).withColumn("similarity", F.round("similarity", 6))


_ONE_UTTERANCE = f"""uw AS (SELECT unnest(string_split(lower(regexp_replace('{UTTERANCE}', '[^a-zA-Z]', ' ', 'g')), ' ')) AS word),
    uv AS (SELECT dim, avg(v) AS q FROM uw JOIN wv_long USING (word) GROUP BY dim)"""


@query(
    "intent_scores",
    parts("docvec", extra=_ONE_UTTERANCE)
    + """SELECT doc_id, round(sum(value * q) / nullif(sqrt(sum(value * value)) * sqrt(sum(q * q)), 0), 6) AS similarity
         FROM docvec JOIN uv USING (dim) GROUP BY doc_id
         HAVING sum(value * value) > 0""",
)
def intent_scores(spark, sf):
    """One utterance against every document vector; rows without a vector have no score."""
    rows = data.bags(spark, sf)
    table = data.word_vectors(spark, sf, rows)
    docs = vectors.mean_word_vectors(rows, table, WIDTH)
    asked = spark.createDataFrame([(0, UTTERANCE)], "query_id bigint, text string").select(
        "query_id", tx.clean_words(F.col("text")).alias("words")
    )
    utterance = vectors.mean_word_vectors(asked, table, WIDTH, "query_id")
    scored = similarity.intent_scores(docs, utterance).filter(F.col("similarity").isNotNull())
    return scored.select("doc_id", F.round("similarity", 6).alias("similarity"))


# Words of the documents that stand at least so often are known to the spelling.
SPELLING_FLOOR = 10

# The query side of the intent jobs: words of user turns, then lemmas, then stop words out.
_ASKED = r"""uq AS (SELECT conv_id * 1000 + turn AS query_id, text FROM conversations WHERE role = 'user'),
    uword AS (SELECT query_id, unnest(list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> '')) AS word
              FROM uq)"""
# the known words are plain letters, so any other character of a word is one more that differs
_PLAIN = r"regexp_replace(u.word, '[^\x00-\x7F]', '~', 'g')"
_UNKNOWN = f"""sv1 AS (SELECT word, cf AS n FROM freq WHERE cf >= {SPELLING_FLOOR}),
    unk AS (SELECT DISTINCT word FROM uword WHERE word NOT IN (SELECT word FROM sv1)),
    cand AS (SELECT u.word, s.word AS correction, s.n, levenshtein({_PLAIN}, s.word) AS distance
             FROM unk u JOIN sv1 s ON abs(length(u.word) - length(s.word)) <= 2 WHERE levenshtein({_PLAIN}, s.word) <= 2),
    fix AS (SELECT word, correction, distance FROM (SELECT *, row_number() OVER
             (PARTITION BY word ORDER BY distance, n DESC, correction) AS r FROM cand) WHERE r = 1)"""


def _asked_words(spark, sf):
    return data.utterances(spark, sf).select("query_id", tx.document_tokens(F.col("text")).alias("words"))


def _corrections(spark, sf, rows, asked):
    """Corrections of the words that the documents do not have ``SPELLING_FLOOR`` times."""
    vocab = weights.vocabulary_bounds(rows).filter(F.col("cf") >= SPELLING_FLOOR)
    return lexical.spell_candidates(tokens.explode_words(asked), vocab.select("word", F.col("cf").alias("n")))


@query("spell_candidates", parts("freq", extra=_ASKED + ",\n" + _UNKNOWN) + "SELECT word, correction, distance FROM fix")
def spell_candidates(spark, sf):
    return _corrections(spark, sf, data.bags(spark, sf), _asked_words(spark, sf))


def _similar_sql(k: int, corrected: bool) -> str:
    words = (
        "SELECT query_id, coalesce(f.correction, u.word) AS word FROM uword u LEFT JOIN fix f USING (word)"
        if corrected
        else "SELECT query_id, word FROM uword"
    )
    extra = _ASKED + (",\n" + _UNKNOWN if corrected else "")
    return parts("docvec", extra=extra) + f""",
        cw AS ({words}),
        {lemma_parts("cw", lexicon="freq")},
        qw AS (SELECT query_id, coalesce(lemma, word) AS word FROM cw LEFT JOIN lemmas USING (word)
               WHERE coalesce(lemma, word) NOT IN ({STOPS})),
        qv AS (SELECT query_id, dim, avg(v) AS q FROM qw JOIN wv_long USING (word) GROUP BY query_id, dim),
        qa AS (SELECT query_id, list(q ORDER BY dim) AS q FROM qv GROUP BY query_id),
        da AS (SELECT doc_id, list(value ORDER BY dim) AS d FROM docvec GROUP BY doc_id HAVING sum(value * value) > 0),
        dd AS (SELECT list_transform(d, lambda x: round(x, 12)) AS d, min(doc_id) AS doc_id
               FROM da GROUP BY 1),
        sc AS (SELECT query_id, doc_id, round(list_cosine_similarity(q, d), 9) AS s FROM qa, dd),
        rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM sc)
        """


def _matches(spark, sf, k, corrected):
    rows = data.bags(spark, sf)
    # read for the queries and for the documents
    table = cut_lineage(data.word_vectors(spark, sf, rows))
    asked = cut_lineage(_asked_words(spark, sf))
    if corrected:
        fixes = _corrections(spark, sf, rows, asked).select("word", F.col("correction").alias("lemma"))
        asked = cut_lineage(tokens.map_words(asked, fixes, ["query_id"]))
    lemmas = lexical.lemma_table(tokens.explode_words(asked), lexicon=stats.doc_frequency(rows).select("word"))
    asked = tokens.map_words(asked, lemmas, ["query_id"]).withColumn("words", tx.without(F.col("words")))
    queries = vectors.mean_word_vectors(asked, table, WIDTH, "query_id")
    stored = vectors.mean_word_vectors(rows, table, WIDTH).withColumnRenamed("doc_id", "stored_id")
    # copies of a text can differ in the last bit of a sum; rounded, they are equal
    stored = stored.withColumn("vector", F.transform("vector", lambda x: F.round(x, 12)))
    return similarity.nearest_rows(queries, stored, k)


@query(
    "top_matches",
    _similar_sql(3, False)
    + "SELECT query_id, rank, doc_id AS stored_id, s AS similarity FROM rk WHERE rank <= 3",
)
def top_matches(spark, sf):
    """Three best documents for every user turn."""
    return _matches(spark, sf, 3, False).select("query_id", "rank", "stored_id", "similarity")


@query(
    "get_intent",
    _similar_sql(1, True)
    + """SELECT query_id, doc_id AS stored_id, lang AS intent, s AS similarity
         FROM rk JOIN documents USING (doc_id) WHERE rank = 1""",
)
def get_intent(spark, sf):
    """Spelling, vector and best labelled row for every user turn."""
    labelled = read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("stored_id"), F.col("lang").alias("intent")
    )
    return similarity.best_intent(_matches(spark, sf, 1, True), labelled)


@query(
    "argmax_per_query",
    _similar_sql(1, False)
    + "SELECT query_id, doc_id AS stored_id, s AS similarity, round(1 - s, 9) AS distance FROM rk WHERE rank = 1",
)
def argmax_per_query(spark, sf):
    """Best row of every user turn without spelling correction, as similarity and distance."""
    best = _matches(spark, sf, 1, False)
    return best.select(
        "query_id", "stored_id", "similarity", F.round(1 - F.col("similarity"), 9).alias("distance")
    )


@query(
    "similar_pairs",
    """WITH v AS (SELECT min(vec_id) AS id, count(*) AS copies, CAST(embedding AS DOUBLE[]) AS e
                  FROM embeddings GROUP BY embedding)
       SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.e, b.e), 9) AS similarity,
              a.copies AS copies_a, b.copies AS copies_b
       FROM v a JOIN v b ON a.id < b.id WHERE round(list_cosine_similarity(a.e, b.e), 9) >= 0.3""",
)
def similar_pairs(spark, sf):
    """All pairs of embeddings whose cosine is at least 0.3."""
    return similarity.similar_pairs(data.embeddings(spark, sf), 0.3, block_rows=128)
