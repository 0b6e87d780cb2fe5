"""Phrases, bags of words and TF-IDF (survey J1-J8, E11-E13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslab.functions.words import ENGLISH_STOP_WORDS
from corpuslab.operators import ordering, phrases, tokens, weights
from corpuslab.plans import data
from corpuslab.plans.registry import query
from corpuslab.plans.sqlparts import parts
from corpuslab.sources.readers import read_table

TOP_PHRASES = 20
# the published threshold, and a lower one that small collections reach as well
RARE_PHRASE, SCARCE_PHRASE = 500, 20
# bounds of the headline vocabulary: least documents, greatest share of documents, most words
BAG_BOUNDS = {"min_df": 15, "max_share": 0.5, "keep": 100_000}

_VOCAB_SQL = "(SELECT first || '_' || second AS token, n FROM pairs)"


@query("phrase_counts", parts("pairs") + f"SELECT token, n FROM {_VOCAB_SQL}")
def phrase_counts(spark, sf):
    return phrases.phrase_counts(phrases.phrase_vocab(data.clean(spark, sf)))


@query("top_phrases", parts("pairs") + f"SELECT token, n FROM {_VOCAB_SQL} ORDER BY n DESC, token LIMIT {TOP_PHRASES}")
def top_phrases(spark, sf):
    counted = phrases.phrase_counts(phrases.phrase_vocab(data.clean(spark, sf)))
    return ordering.head(counted, TOP_PHRASES, F.desc("n"), "token")


@query("drop_rare_phrases", parts("pairs") + f"SELECT token, n FROM {_VOCAB_SQL} WHERE n > {RARE_PHRASE}")
def drop_rare_phrases(spark, sf):
    counted = phrases.phrase_counts(phrases.phrase_vocab(data.clean(spark, sf)))
    return phrases.drop_rare_phrases(counted, RARE_PHRASE)


@query("drop_scarce_phrases", parts("pairs") + f"SELECT token, n FROM {_VOCAB_SQL} WHERE n > {SCARCE_PHRASE}")
def drop_scarce_phrases(spark, sf):
    counted = phrases.phrase_counts(phrases.phrase_vocab(data.clean(spark, sf)))
    return phrases.drop_rare_phrases(counted, SCARCE_PHRASE)


@query(
    "phrase_scores",
    parts("phrases") + "SELECT first, second, n, round(score, 6) AS score FROM phrases WHERE score > 10",
)
def phrase_scores(spark, sf):
    scored = phrases.phrase_scores(data.clean(spark, sf))
    return scored.withColumn("score", F.round("score", 6))


# Greedy left-to-right merging as gaps and islands over one token table.
def merge_parts(source: str, accepted: str, prefix: str) -> str:
    """CTEs that end in ``<prefix>tok`` (doc_id, sent_pos, pos, token)."""
    return f"""{prefix}t AS (SELECT doc_id, sent_pos, pos, token,
             lead(token) OVER (PARTITION BY doc_id, sent_pos ORDER BY pos) AS nxt FROM {source}),
        {prefix}f AS (SELECT t.*, a.first IS NOT NULL AS hit FROM {prefix}t t
             LEFT JOIN {accepted} a ON a.first = t.token AND a.second = t.nxt),
        {prefix}r AS (SELECT *, max(CASE WHEN NOT hit THEN pos END) OVER
             (PARTITION BY doc_id, sent_pos ORDER BY pos) AS last_miss FROM {prefix}f),
        {prefix}c AS (SELECT *, hit AND (pos - coalesce(last_miss, -1) - 1) % 2 = 0 AS chosen FROM {prefix}r),
        {prefix}k AS (SELECT *, coalesce(lag(chosen) OVER (PARTITION BY doc_id, sent_pos ORDER BY pos), FALSE)
             AS consumed FROM {prefix}c),
        {prefix}tok AS (SELECT doc_id, sent_pos, pos,
             CASE WHEN chosen THEN token || '_' || nxt ELSE token END AS token FROM {prefix}k WHERE NOT consumed)"""


_TOK0 = """tok0 AS (SELECT doc_id, sent_pos, generate_subscripts(words, 1) - 1 AS pos, unnest(words) AS token
                   FROM clean),
        acc AS (SELECT first, second FROM phrases WHERE score > 10)"""
_TRI = """tri0 AS (SELECT doc_id, sent_pos, row_number() OVER (PARTITION BY doc_id, sent_pos ORDER BY pos) - 1 AS pos,
                          token FROM btok),
        ts AS (SELECT token, count(*) AS n FROM tri0 GROUP BY token),
        tp AS (SELECT token AS first, nxt AS second, count(*) AS n FROM (
                 SELECT token, lead(token) OVER (PARTITION BY doc_id, sent_pos ORDER BY pos) AS nxt FROM tri0)
               WHERE nxt IS NOT NULL GROUP BY 1, 2),
        tacc AS (SELECT p.first, p.second FROM tp p JOIN ts a ON a.token = p.first JOIN ts b ON b.token = p.second
                 WHERE p.n > 5 AND (p.n - 5) / a.n / b.n
                   * ((SELECT count(*) FROM ts) + (SELECT count(*) FROM tp)) > 10)"""


def _sentences_of(cte: str) -> str:
    return (
        "SELECT c.doc_id, c.sent_pos, coalesce(string_agg(t.token, ' ' ORDER BY t.pos), '') AS words"
        f" FROM clean c LEFT JOIN {cte} t USING (doc_id, sent_pos) GROUP BY c.doc_id, c.sent_pos"
    )


def _joined(rows):
    return rows.select("doc_id", "sent_pos", F.array_join("words", " ").alias("words"))


@query(
    "merge_phrases",
    parts("phrases", "clean", extra=_TOK0 + ",\n" + merge_parts("tok0", "acc", "b")) + _sentences_of("btok"),
)
def merge_phrases(spark, sf):
    return _joined(phrases.bigrams(data.clean(spark, sf)))


@query(
    "trigrams",
    parts(
        "phrases", "clean",
        extra=_TOK0 + ",\n" + merge_parts("tok0", "acc", "b") + ",\n" + _TRI + ",\n" + merge_parts("tri0", "tacc", "t"),
    )
    + _sentences_of("ttok"),
)
def trigrams(spark, sf):
    return _joined(phrases.trigrams(data.clean(spark, sf)))


_BENCH_WORDS = """bw AS (SELECT list_filter(string_split(lower(regexp_replace(s, '[^a-zA-Z]', ' ', 'g')), ' '),
                                 lambda w: w <> '') AS words
        FROM (SELECT unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS s
              FROM benchmark) WHERE NOT starts_with(s, '=='))"""


@query(
    "extend_phrase_vocab",
    parts("pairs", "singles", "lettered", extra=_BENCH_WORDS)
    + """SELECT token, CAST(sum(n) AS BIGINT) AS n FROM (
           SELECT word AS token, n FROM singles UNION ALL SELECT first || '_' || second, n FROM pairs
           UNION ALL SELECT w, 1 FROM (SELECT unnest(words) AS w FROM bw)
           UNION ALL SELECT p[1] || '_' || p[2], 1 FROM (
             SELECT unnest(list_zip(words[1:len(words) - 1], words[2:])) AS p FROM bw WHERE len(words) > 1))
         GROUP BY token""",
)
def extend_phrase_vocab(spark, sf):
    more = tokens.clean_sentences(read_table(spark, sf, "benchmark"), key="item_id", remove_stops=False)
    return phrases.extend_phrase_vocab(
        phrases.phrase_vocab(data.clean(spark, sf)), phrases.phrase_vocab(more)
    )


@query(
    "phrase_vocabulary",
    parts("pairs")
    + f"SELECT row_number() OVER (ORDER BY n DESC, token) AS rank, token, n FROM {_VOCAB_SQL}"
    f" WHERE n > {SCARCE_PHRASE}",
)
def phrase_vocabulary(spark, sf):
    """All kept phrases, numbered in order of strength."""
    counted = phrases.phrase_counts(phrases.phrase_vocab(data.clean(spark, sf)), ENGLISH_STOP_WORDS)
    kept = phrases.drop_rare_phrases(counted, SCARCE_PHRASE)
    ranked = ordering.dense_index(kept, [F.desc("n"), "token"], "at")
    return ranked.select((F.col("at") + 1).alias("rank"), "token", "n")


_BAG = f"""voc AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS word_id FROM (
             SELECT word FROM freq, nd WHERE df >= {BAG_BOUNDS['min_df']} AND df <= {BAG_BOUNDS['max_share']} * n_docs
             ORDER BY df DESC, word LIMIT {BAG_BOUNDS['keep']}))"""


def _bounded(rows):
    return weights.word_ids(weights.vocabulary_bounds(rows, **BAG_BOUNDS), capped=False).select("word", "word_id")


def _capped(rows):
    vocab = weights.vocabulary_bounds(rows, min_df=2, max_share=0.95, keep=1000, by="cf")
    return weights.word_ids(vocab, capped=True)


@query(
    "bag_of_words",
    parts("post", "freq", "nd", extra=_BAG) + "SELECT doc_id, word_id, n FROM post JOIN voc USING (word)",
)
def bag_of_words(spark, sf):
    rows = data.bags(spark, sf)
    return weights.bag_of_words(rows, _bounded(rows))


@query(
    "id_to_word",
    parts("post", "freq", "nd", extra=_BAG) + "SELECT doc_id, word_id, word, n FROM post JOIN voc USING (word)",
)
def id_to_word(spark, sf):
    rows = data.bags(spark, sf)
    vocab = _bounded(rows)
    return weights.id_to_word(weights.bag_of_words(rows, vocab), vocab)


@query(
    "word_ids",
    parts("freq") + "SELECT word, row_number() OVER (ORDER BY word) - 1 AS word_id FROM freq",
)
def word_ids(spark, sf):
    vocab = weights.vocabulary_bounds(data.words(spark, sf))
    return weights.word_ids(vocab, capped=False).select("word", "word_id")


@query(
    "count_matrix",
    parts("clean", "nd", extra="""cm AS (SELECT doc_id, word, count(*) AS n FROM (
              SELECT doc_id, unnest(words) AS word FROM clean) WHERE length(word) >= 2 GROUP BY ALL),
         cv AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS word_id FROM (
              SELECT word FROM cm GROUP BY word
              HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT n_docs FROM nd)
              ORDER BY sum(n) DESC, word LIMIT 1000))""")
    + "SELECT doc_id, word_id, n FROM cm JOIN cv USING (word)",
)
def count_matrix(spark, sf):
    """Counts over a bounded vocabulary of words of at least two letters."""
    rows = data.bags(spark, sf).withColumn("bag", F.filter("bag", lambda w: F.length(w["word"]) >= 2))
    return weights.bag_of_words(rows, _capped(rows))


def _weights_sql(idf: str, where: str) -> str:
    return (
        parts("post", "freq", "nd", extra=f"idf AS (SELECT word, {idf} AS idf FROM freq, nd WHERE {where})")
        + """, raw AS (SELECT doc_id, word, n, idf, n * idf AS w FROM post JOIN idf USING (word)),
               unit AS (SELECT *, w / nullif(sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 0) AS weight FROM raw)
        """
    )


_SMOOTH = _weights_sql("ln((1.0 + n_docs) / (1.0 + df)) + 1.0", "df >= 2")
_LOG2 = _weights_sql("log2(n_docs / df)", "df >= 3 AND df <= 0.8 * n_docs")


def _rounded(rows):
    return rows.withColumns({"idf": F.round("idf", 6), "weight": F.round("weight", 6)})


@query(
    "tf_idf_smooth",
    _SMOOTH + "SELECT doc_id, word, n, round(idf, 6) AS idf, round(weight, 6) AS weight FROM unit",
)
def tf_idf_smooth(spark, sf):
    return _rounded(weights.tf_idf_smooth(data.bags(spark, sf), min_df=2))


@query(
    "tf_idf_log2",
    _LOG2 + "SELECT doc_id, word, n, round(idf, 6) AS idf, round(weight, 6) AS weight FROM unit WHERE weight > 1e-12",
)
def tf_idf_log2(spark, sf):
    return _rounded(weights.tf_idf_log2(data.bags(spark, sf), min_df=3, max_share=0.8))


@query(
    "idf_weights",
    parts("freq", "nd") + "SELECT word, round(ln((1.0 + n_docs) / (1.0 + df)) + 1.0, 6) AS idf FROM freq, nd WHERE df >= 10",
)
def idf_weights(spark, sf):
    rows = data.bags(spark, sf)
    vocab = weights.vocabulary_bounds(rows, min_df=10)
    return weights.smooth_idf(vocab, weights.document_count(rows)).select("word", F.round("idf", 6).alias("idf"))


@query(
    "strongest_words",
    _SMOOTH
    + """SELECT doc_id, rank, word, weight FROM (
           SELECT doc_id, word, round(weight, 6) AS weight,
                  row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, word) AS rank FROM unit)
         WHERE rank <= 10""",
)
def strongest_words(spark, sf):
    """Ten strongest TF-IDF words of every document."""
    weighed = weights.tf_idf_smooth(data.bags(spark, sf), min_df=2)
    best = ordering.top_per_group(weighed, "doc_id", 10, F.desc(F.round("weight", 9)), "word")
    return best.select("doc_id", "rank", "word", F.round("weight", 6).alias("weight"))
