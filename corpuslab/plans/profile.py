"""Counts, profiles and windows (survey E, F)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.operators import lexical, phrases, stats, tables, tokens, weights
from corpuslab.operators.unnest import each_at
from corpuslab.plans import data
from corpuslab.plans.registry import query
from corpuslab.plans.sqlparts import STOPS, lemma_parts, parts, stem_parts
from corpuslab.plans.tables import MASKED, good
from corpuslab.session import cut_lineage
from corpuslab.sources.readers import read_table

# Words as the topic models see them: masked, tidied, stop words out, noun lemmas, stems.
PREPARED_WORDS = f"""tw AS (SELECT * FROM (SELECT doc_id, unnest({good(MASKED)}) AS word FROM documents)
               WHERE word NOT IN ('qwerty', {STOPS})),
        {lemma_parts("tw")},
        norm AS (SELECT doc_id, m.lemma AS word FROM tw JOIN lemmas m USING (word)),
        {stem_parts("norm")},
        counted AS (SELECT doc_id, stem AS word, count(*) AS n FROM norm JOIN stems USING (word) GROUP BY ALL)"""
LENGTHS = "lengths AS (SELECT doc_id, len(string_split(text, ' ')) AS x FROM documents)"


@query(
    "corpus_shape",
    parts("sent")
    + "SELECT (SELECT count(*) FROM sent) AS n_sentences, (SELECT count(*) FROM documents) AS n_texts",
)
def corpus_shape(spark, sf):
    docs = data.documents(spark, sf)
    return docs.agg(
        F.sum(F.size(tx.sentences(F.col("text")))).alias("n_sentences"), F.count("*").alias("n_texts")
    )


@query(
    "null_counts",
    """SELECT count(*) FILTER (WHERE d.doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE d.text IS NULL) AS text,
              count(*) FILTER (WHERE l.quality IS NULL) AS sentiment
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def null_counts(spark, sf):
    return stats.null_counts(data.messages(spark, sf).select("doc_id", "text", "sentiment"))


@query("docs_per_author", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def docs_per_author(spark, sf):
    return stats.value_counts(read_table(spark, sf, "documents"), "lang").orderBy(F.desc("n"), "lang")


@query(
    "length_stats",
    f"WITH {LENGTHS} SELECT round(avg(x), 6) AS mean_words, min(x) AS min_words, max(x) AS max_words FROM lengths",
)
def length_stats(spark, sf):
    return stats.length_stats(data.documents(spark, sf)).withColumn("mean_words", F.round("mean_words", 6))


@query(
    "length_counts",
    f"""WITH {LENGTHS} SELECT count(*) FILTER (WHERE x > 150) AS n_long,
        count(*) FILTER (WHERE x <= 5) AS n_short FROM lengths""",
)
def length_counts(spark, sf):
    return stats.length_counts(data.documents(spark, sf))


def _bins(source: str) -> str:
    return f"""SELECT CAST(least(floor((x - lo) * 50 / (hi - lo)), 49) AS BIGINT) AS bin, count(*) AS n
        FROM {source}, (SELECT min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM {source}) GROUP BY 1"""


@query("length_histogram", f"WITH {LENGTHS} {_bins('lengths')}")
def length_histogram(spark, sf):
    rows = tables_lengths(spark, sf)
    return stats.histogram(rows, "n_words")


@query(
    "length_histogram_short",
    f"WITH {LENGTHS}, short AS (SELECT x FROM lengths WHERE x <= 150) {_bins('short')}",
)
def length_histogram_short(spark, sf):
    return stats.histogram(tables_lengths(spark, sf).filter("n_words <= 150"), "n_words")


def tables_lengths(spark, sf):
    return data.documents(spark, sf).select(F.size(tx.split_space(F.col("text"))).alias("n_words"))


GOOD_WORDS = f"gw AS (SELECT doc_id, lang, {good('lower(text)')} AS words FROM documents)"


@query(
    "word_counts",
    f"WITH {GOOD_WORDS} SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM gw) GROUP BY word",
)
def word_counts(spark, sf):
    return stats.word_counts(_good_words(spark, sf))


def _good_words(spark, sf):
    docs = data.documents(spark, sf, "doc_id", "lang", "text")
    return docs.select(
        "doc_id", F.col("lang").alias("author"),
        tx.good_words(F.lower("text")).alias("words"),
    )


@query(
    "top_words",
    f"""WITH {GOOD_WORDS} SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM gw)
        GROUP BY word ORDER BY n DESC, word LIMIT 50""",
)
def top_words(spark, sf):
    return stats.word_counts(_good_words(spark, sf)).orderBy(F.desc("n"), "word").limit(50)


@query("doc_frequency", parts("freq") + "SELECT word, df FROM freq")
def doc_frequency(spark, sf):
    return stats.doc_frequency(data.words(spark, sf))


@query(
    "word_counts_by_author",
    f"""WITH {PREPARED_WORDS},
        topw AS (SELECT word, count(*) AS df FROM counted GROUP BY word ORDER BY df DESC, word LIMIT 50),
        authors AS (SELECT DISTINCT coalesce(lang, '') AS author FROM documents),
        sums AS (SELECT coalesce(lang, '') AS author, word, sum(n) AS n
                 FROM counted JOIN documents USING (doc_id) GROUP BY ALL)
        SELECT word, df, author, CAST(coalesce(n, 0) AS BIGINT) AS n,
               CAST(sum(coalesce(n, 0)) OVER (PARTITION BY word ORDER BY author) AS BIGINT) AS upto
        FROM topw CROSS JOIN authors LEFT JOIN sums USING (word, author)""",
)
def word_counts_by_author(spark, sf):
    """Counts of the fifty commonest prepared words for every author of the table."""
    docs = data.documents(spark, sf)
    nouns = lexical.lemma_table(tokens.explode_words(tokens.topic_words(docs, stem=False)))
    authors = read_table(spark, sf, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("author"))
    rows = cut_lineage(tokens.topic_words(docs, lemmas=nouns).join(authors, "doc_id"))
    top = stats.doc_frequency(rows).orderBy(F.desc("df"), "word").limit(50)
    return stats.word_counts_by_author(rows, cut_lineage(top))


@query(
    "nonascii_words",
    r"""SELECT doc_id, word, count(*) AS n
        FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
        WHERE regexp_matches(word, '[^\x00-\x7F]') GROUP BY ALL""",
)
def nonascii_words(spark, sf):
    return stats.nonascii_words(data.documents(spark, sf))


_SPECTRUM = """s AS (SELECT row_number() OVER (ORDER BY e DESC, dim) AS rank, sqrt(e) AS s FROM (
    SELECT dim, sum(v * v) AS e FROM (SELECT generate_subscripts(embedding, 1) - 1 AS dim,
    CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY dim))"""


def _spectrum(spark, sf):
    """One value per dimension: the length of that column of the vector table."""
    long = data.embeddings(spark, sf).select(F.posexplode("vector").alias("dim", "v"))
    energy = long.groupBy("dim").agg(F.sum(F.col("v") * F.col("v")).alias("e"))
    # one row per dimension of the vectors
    rank = F.row_number().over(W.orderBy(F.desc("e"), "dim"))
    return energy.select(rank.alias("rank"), F.sqrt("e").alias("s"))


@query(
    "energy_rank",
    f"""WITH {_SPECTRUM}, r AS (SELECT rank, sum(s * s) OVER (ORDER BY rank) AS c, sum(s * s) OVER () AS t FROM s)
        SELECT min(rank) AS k FROM r WHERE c >= 0.85 * t""",
)
def energy_rank(spark, sf):
    return stats.energy_rank(_spectrum(spark, sf))


@query(
    "running_energy",
    f"WITH {_SPECTRUM} SELECT rank, round(sum(s * s) OVER (ORDER BY rank), 6) AS energy FROM s",
)
def running_energy(spark, sf):
    total = F.sum(F.col("s") * F.col("s")).over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, 0))
    return _spectrum(spark, sf).select("rank", F.round(total, 6).alias("energy"))


@query(
    "numbering",
    parts("clean")
    + """SELECT doc_id, sent_pos, row_number() OVER (PARTITION BY doc_id ORDER BY sent_pos) AS sent_no
         FROM clean WHERE len(words) > 2""",
)
def numbering(spark, sf):
    """Number the kept sentences of each document; the sentences stay in their document's row."""
    docs = data.documents(spark, sf)
    numbered = F.transform(
        tx.sentences(F.col("text")),
        lambda s, i: F.struct(i.alias("sent_pos"), F.size(tx.clean_words(s)).alias("n_words")),
    )
    kept = F.filter(numbered, lambda s: s["n_words"] > 2)
    rows = each_at(docs, kept, "i", "s", "doc_id")
    return rows.select("doc_id", F.col("s.sent_pos").alias("sent_pos"), (F.col("i") + 1).alias("sent_no"))


@query(
    "adjacent_pairs",
    parts("pairs") + "SELECT first, second, n FROM pairs",
)
def adjacent_pairs(spark, sf):
    return phrases.pair_counts(data.clean(spark, sf))


@query(
    "vocabulary_size",
    parts("freq", "nd")
    + """SELECT count(*) AS n_found, count(*) FILTER (WHERE df >= 3 AND df <= 0.8 * n_docs) AS n_left
         FROM freq, nd""",
)
def vocabulary_size(spark, sf):
    rows = data.words(spark, sf)
    found = weights.vocabulary_bounds(rows)
    n_docs = weights.document_count(rows)
    left = (F.col("df") >= 3) & (F.col("df") <= 0.8 * n_docs)
    return found.withColumn("left", left).agg(
        F.count("*").alias("n_found"), F.count_if("left").alias("n_left")
    )


_VARIANTS = {
    "headlines": ("df >= 15 AND df <= 0.5 * n_docs", 100_000, "df"),
    "authors": ("df >= 3 AND df <= 0.8 * n_docs", None, "df"),
    "sentences": ("df >= 2 AND df <= 0.95 * n_docs", 1_000, "cf"),
    "messages": ("df >= 10", None, "df"),
}


def _bounds_sql() -> str:
    selects = []
    for name, (condition, keep, by) in _VARIANTS.items():
        limit = f" ORDER BY {by} DESC, word LIMIT {keep}" if keep else ""
        selects.append(
            f"(SELECT '{name}' AS variant, word, cf, df FROM freq, nd WHERE {condition}{limit})"
        )
    return parts("freq", "nd") + " UNION ALL ".join(selects)


@query("vocabulary_bounds", _bounds_sql())
def vocabulary_bounds(spark, sf):
    rows = data.words(spark, sf)
    frequencies, n_docs = cut_lineage(stats.word_frequencies(rows)), weights.document_count(rows)
    variants = {
        "headlines": dict(min_df=15, max_share=0.5, keep=100_000),
        "authors": dict(min_df=3, max_share=0.8),
        "sentences": dict(min_df=2, max_share=0.95, keep=1_000, by="cf"),
        "messages": dict(min_df=10),
    }
    frames = [
        weights.bound_vocabulary(frequencies, n_docs, **bounds).select(F.lit(name).alias("variant"), "word", "cf", "df")
        for name, bounds in variants.items()
    ]
    return tables.append_rows(*frames)


@query(
    "masked_topic_words",
    f"""WITH gw AS (SELECT doc_id, {good(MASKED)} AS words FROM documents)
        SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM gw)
        WHERE word NOT IN ('qwerty', {STOPS}) GROUP BY ALL""",
)
def masked_topic_words(spark, sf):
    rows = tokens.topic_words(data.documents(spark, sf), stem=False)
    return weights.postings(rows)
