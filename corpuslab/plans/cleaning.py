"""Text functions over whole tables (survey I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.functions import vectors as vx
from corpuslab.functions.stem import stem_word
from corpuslab.functions.words import VERB_RULES
from corpuslab.operators import lexical, tokens, vectors, weights
from corpuslab.operators.unnest import each, each_at
from corpuslab.plans import data
from corpuslab.plans.registry import query
from corpuslab.plans.sqlparts import STOPS, lemma_parts, parts, stem_parts
from corpuslab.plans.tables import MASKED, SOCIAL_SQL, good
from corpuslab.session import cut_lineage, lookup
from corpuslab.sources.readers import read_table


def _text_query(name: str, column, sql: str) -> None:
    """A query that maps the text of every document."""

    @query(name, f"SELECT doc_id, {sql} AS text FROM documents")
    def mapped(spark, sf):
        return data.documents(spark, sf).select("doc_id", column(F.col("text")).alias("text"))


_text_query("lowercase", tx.lowercase, "lower(text)")
_text_query("letters_only", tx.letters_only, "regexp_replace(text, '[^a-zA-Z]', ' ', 'g')")
_text_query("ascii_fold", tx.ascii_fold, r"regexp_replace(text, '[^\x00-\x7F]', '', 'g')")
_text_query("mask_nonascii", lambda t: F.lower(tx.mask_nonascii(t)), MASKED)
_text_query(
    "drop_integers",
    tx.drop_integers,
    r"array_to_string(list_filter(string_split_regex(text, '\s+'),"
    r" lambda w: w <> '' AND NOT regexp_matches(w, '^[+-]?[0-9]+$')), ' ')",
)
_text_query(
    "document_tokens",
    lambda t: tx.join_tokens(tx.document_tokens(t)),
    r"array_to_string(list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> ''), ' ')",
)
_text_query("good_tokens", lambda t: tx.join_tokens(tx.good_tokens(tx.word_tokens(t))), f"array_to_string({good('text')}, ' ')")


def _counts_query(name: str, column, sql: str) -> None:
    """A query that counts the tokens of every document."""

    @query(
        name,
        f"SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({sql}) AS token FROM documents) GROUP BY ALL",
    )
    def counted(spark, sf):
        docs = data.documents(spark, sf)
        single = each(docs, column(F.col("text")), "token", "doc_id")
        return single.groupBy("doc_id", "token").agg(F.count("*").alias("n"))


_counts_query(
    "split_whitespace", tx.split_whitespace,
    r"list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')",
)
_counts_query("split_space", tx.split_space, "string_split(text, ' ')")
_counts_query("word_tokens", tx.word_tokens, r"regexp_extract_all(text, '[A-Za-z0-9]+|[^\sA-Za-z0-9]')")
_counts_query("social_tokens", tx.social_tokens, SOCIAL_SQL)


@query("clean_sentence", parts("clean") + "SELECT doc_id, sent_pos, array_to_string(words, ' ') AS words FROM clean")
def clean_sentence(spark, sf):
    rows = data.clean(spark, sf)
    return rows.select("doc_id", "sent_pos", tx.join_tokens(F.col("words")).alias("words"))


_LEMMA_WORDS = """lt AS (SELECT doc_id, sent_pos, generate_subscripts(words, 1) AS pos, unnest(words) AS word
                         FROM lettered)"""


@query(
    "clean_sentence_lemmas",
    parts("lettered", extra=_LEMMA_WORDS + ",\n" + lemma_parts("lt"))
    + f"""SELECT l.doc_id, l.sent_pos,
                 coalesce(string_agg(m.lemma, ' ' ORDER BY t.pos) FILTER (WHERE m.lemma NOT IN ({STOPS})), '') AS words
          FROM lettered l LEFT JOIN lt t USING (doc_id, sent_pos) LEFT JOIN lemmas m ON m.word = t.word
          GROUP BY l.doc_id, l.sent_pos""",
)
def clean_sentence_lemmas(spark, sf):
    """Cleaned sentences with lemmas, the corpus's own words as lexicon."""
    docs = data.documents(spark, sf)
    corpus = tokens.explode_words(tokens.document_words(docs, stops=None))
    rows = tokens.clean_sentences(docs, lemmas=lexical.lemma_table(corpus))
    return rows.select("doc_id", "sent_pos", tx.join_tokens(F.col("words")).alias("words"))


@query(
    "clean_sentence_stems",
    parts("lettered", extra=_LEMMA_WORDS + ",\n" + stem_parts("lt"))
    + f"""SELECT l.doc_id, l.sent_pos,
                 coalesce(string_agg(m.stem, ' ' ORDER BY t.pos) FILTER (WHERE m.stem NOT IN ({STOPS})), '') AS words
          FROM lettered l LEFT JOIN lt t USING (doc_id, sent_pos) LEFT JOIN stems m ON m.word = t.word
          GROUP BY l.doc_id, l.sent_pos""",
)
def clean_sentence_stems(spark, sf):
    rows = data.clean(spark, sf, stem=True)
    return rows.select("doc_id", "sent_pos", tx.join_tokens(F.col("words")).alias("words"))


@query(
    "clean_utterance",
    rf"""WITH split AS (SELECT conv_id, turn, list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> '') AS ws
                 FROM conversations),
        said AS (SELECT conv_id, turn, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM split),
        {lemma_parts("said")},
        kept AS (SELECT conv_id, turn, pos, lemma FROM said JOIN lemmas USING (word) WHERE lemma NOT IN ({STOPS}))
        SELECT conv_id, turn, coalesce(words, '') AS words FROM split LEFT JOIN (
            SELECT conv_id, turn, string_agg(lemma, ' ' ORDER BY pos) AS words FROM kept GROUP BY ALL
        ) USING (conv_id, turn)""",
)
def clean_utterance(spark, sf):
    """Lower case, split, noun lemmas (all turns' words as lexicon), stop words out."""
    rows = cut_lineage(
        read_table(spark, sf, "conversations").select("conv_id", "turn", tx.document_tokens(F.col("text")).alias("words"))
    )
    lemmas = lexical.lemma_table(tokens.explode_words(rows))
    said = tokens.map_words(rows, lemmas, ["conv_id", "turn"])
    return said.select("conv_id", "turn", tx.join_tokens(tx.without(F.col("words"))).alias("words"))


@query("sentences", parts("sent") + "SELECT doc_id, sent_pos, sentence FROM sent")
def sentences(spark, sf):
    return tokens.sentence_rows(data.documents(spark, sf))


@query(
    "period_sentences",
    """SELECT doc_id, generate_subscripts(s, 1) - 1 AS sent_pos, unnest(s) AS sentence
       FROM (SELECT doc_id, string_split(lower(text), '.') AS s FROM documents)""",
)
def period_sentences(spark, sf):
    cut = tx.period_sentences(F.lower("text"))
    return each_at(data.documents(spark, sf), cut, "sent_pos", "sentence", "doc_id")


@query(
    "stem_words",
    parts("lettered", extra="lt AS (SELECT DISTINCT unnest(words) AS word FROM lettered),\n" + stem_parts("lt"))
    + "SELECT word, stem FROM stems",
)
def stem_words(spark, sf):
    corpus = tokens.explode_words(tokens.document_words(data.documents(spark, sf), stops=None))
    return tokens.map_distinct(corpus, stem_word(F.col("word")), "stem")


@query(
    "lemma_words",
    parts("lettered", extra="lt AS (SELECT DISTINCT unnest(words) AS word FROM lettered),\n" + lemma_parts("lt"))
    + "SELECT word, lemma FROM lemmas WHERE word <> lemma",
)
def lemma_words(spark, sf):
    corpus = tokens.explode_words(tokens.document_words(data.documents(spark, sf), stops=None))
    return lexical.lemma_table(corpus)


_HEADLINE = rf"""hl AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(lower(text), '\p{{L}}+'),
    lambda w: length(w) BETWEEN 4 AND 15 AND w NOT IN ({STOPS}))) AS word FROM documents)"""


_NORMALISED = "norm AS (SELECT doc_id, m.lemma AS word FROM {0} JOIN lemmas m USING (word))"
_COUNT_STEMS = " SELECT doc_id, stem AS word, count(*) AS n FROM norm JOIN stems USING (word) GROUP BY ALL"


@query(
    "simple_preprocess",
    f"WITH {_HEADLINE},\n{lemma_parts('hl', VERB_RULES)},\n{_NORMALISED.format('hl')},\n{stem_parts('norm')}"
    + _COUNT_STEMS,
)
def simple_preprocess(spark, sf):
    """Base tokens, stop and short words out, verb lemma (corpus words as lexicon), stem."""
    docs = data.documents(spark, sf)
    corpus = tokens.explode_words(tokens.headline_words(docs, stem=False))
    verbs = lexical.lemma_table(corpus, part="verb")
    return weights.postings(tokens.headline_words(docs, lemmas=verbs))


@query(
    "stemmed_topic_words",
    f"""WITH tw AS (SELECT * FROM (SELECT doc_id, unnest({good(MASKED)}) AS word FROM documents)
               WHERE word NOT IN ('qwerty', {STOPS})),
        {lemma_parts('tw')},\n{_NORMALISED.format('tw')},\n{stem_parts('norm')}"""
    + _COUNT_STEMS,
)
def stemmed_topic_words(spark, sf):
    """Mask, tokenise, tidy, stop words out, noun lemma, stem."""
    docs = data.documents(spark, sf)
    nouns = lexical.lemma_table(tokens.explode_words(tokens.topic_words(docs, stem=False)))
    return weights.postings(tokens.topic_words(docs, lemmas=nouns))


@query(
    "join_tokens",
    parts("tok", extra="dw AS (SELECT doc_id, flatten(list(words ORDER BY sent_pos)) AS ws FROM clean GROUP BY doc_id)")
    + "SELECT doc_id, array_to_string(ws, ' ') AS words FROM dw",
)
def join_tokens(spark, sf):
    return data.words(spark, sf).select("doc_id", tx.join_tokens(F.col("words")).alias("words"))


@query(
    "is_phrase",
    r"""SELECT doc_id, count(*) FILTER (WHERE len(string_split(token, '_')) > 1) AS n_phrases, count(*) AS n_tokens
        FROM (SELECT doc_id, unnest(list_filter(string_split_regex(replace(text, '-', '_'), '\s+'),
              lambda w: w <> '')) AS token FROM documents) GROUP BY doc_id""",
)
def is_phrase(spark, sf):
    docs = data.documents(spark, sf)
    listed = tx.split_whitespace(F.replace("text", F.lit("-"), F.lit("_")))
    rows = docs.select("doc_id", listed.alias("tokens"))
    return rows.select(
        "doc_id",
        F.size(F.filter("tokens", lambda t: tx.is_phrase(t))).alias("n_phrases"),
        F.size("tokens").alias("n_tokens"),
    ).filter("n_tokens > 0")


_LABEL_MEANS = """e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS dim,
        CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
    m AS (SELECT label, dim, avg(v) AS c FROM e GROUP BY label, dim)"""


def _with_label_mean(spark, sf):
    rows = data.embeddings(spark, sf)
    dim = vectors.vector_width(rows)
    centres = vectors.mean_vector_by(rows, "label", dim).select("label", F.col("vector").alias("centre"))
    return rows.join(lookup(centres), "label")


@query(
    "cosine",
    f"""WITH {_LABEL_MEANS}, c AS (SELECT vec_id, sum(v * c) / nullif(sqrt(sum(v * v)) * sqrt(sum(c * c)), 0) AS s
        FROM e JOIN m USING (label, dim) GROUP BY vec_id)
        SELECT vec_id, round(s, 6) AS similarity, round(1 - s, 6) AS distance FROM c""",
)
def cosine(spark, sf):
    a, b = F.col("vector"), F.col("centre")
    return _with_label_mean(spark, sf).select(
        "vec_id",
        F.round(vx.cosine(a, b), 6).alias("similarity"),
        F.round(vx.cosine_distance(a, b), 6).alias("distance"),
    )


@query(
    "vector_algebra",
    f"""WITH {_LABEL_MEANS}
        SELECT vec_id, round(sum(v * c), 6) AS dot, round(sqrt(sum(c * c)), 6) AS norm,
               round(sum(v * v), 6) AS square_sum, count(*) AS n_reciprocals
        FROM e JOIN m USING (label, dim) GROUP BY vec_id""",
)
def vector_algebra(spark, sf):
    v, c = F.col("vector"), F.col("centre")
    return _with_label_mean(spark, sf).select(
        "vec_id",
        F.round(vx.dot(v, c), 6).alias("dot"),
        F.round(vx.norm(c), 6).alias("norm"),
        F.round(vx.vector_sum(vx.squares(v)), 6).alias("square_sum"),
        F.size(F.filter(vx.reciprocals(v), lambda x: x.isNotNull())).alias("n_reciprocals"),
    )


@query(
    "concat_arrays",
    """SELECT vec_id, len(j) AS width, round(list_sum(j), 6) AS total FROM (
         SELECT vec_id, list_concat(CAST(embedding AS DOUBLE[]),
                list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)) AS j FROM embeddings)""",
)
def concat_arrays(spark, sf):
    v = F.col("vector")
    joined = data.embeddings(spark, sf).select("vec_id", vx.concat_arrays(v, vx.squares(v)).alias("j"))
    return joined.select("vec_id", F.size("j").alias("width"), F.round(vx.vector_sum(F.col("j")), 6).alias("total"))


@query(
    "row_vector_sum",
    "SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings",
)
def row_vector_sum(spark, sf):
    rows = data.embeddings(spark, sf)
    return rows.select("vec_id", F.round(vx.vector_sum(F.col("vector")), 6).alias("total"))
