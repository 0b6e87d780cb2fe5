"""Selection, recoding, splitting, set operations, heads (survey C, G, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.functions import vectors as vx
from corpuslab.functions.words import ENGLISH_STOP_WORDS
from corpuslab.operators import ordering, stats, tables, tokens, weights
from corpuslab.operators.unnest import each, each_struct
from corpuslab.plans import data
from corpuslab.plans.registry import query
from corpuslab.plans.sqlparts import STOPS, parts
from corpuslab.session import lookup
from corpuslab.sources.readers import literal_corpus, read_table

RAW_LABEL = "CASE WHEN l.quality IS NOT NULL THEN CASE WHEN l.quality = 1 THEN l.toxic * 4 ELSE 2 END END"
BUCKET = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100"
SPLIT = f"CASE WHEN {BUCKET} < 80 THEN 'TRAIN' ELSE 'TEST' END"
INLINE_TOPICS = [
    "the", "station", "that with", "nicht", "der die das", "pour", "una", "reading system", "and",
]


@query("select_columns", "SELECT doc_id, lang AS author, n_chars FROM documents")
def select_columns(spark, sf):
    docs = read_table(spark, sf, "documents")
    return tables.select_columns(docs, ["doc_id", "lang", "n_chars"], {"lang": "author"})


@query(
    "not_null",
    f"""SELECT d.doc_id, CAST({RAW_LABEL} AS BIGINT) AS sentiment
        FROM documents d LEFT JOIN labels l USING (doc_id)
        WHERE l.quality IS NOT NULL AND d.text IS NOT NULL""",
)
def not_null(spark, sf):
    rows = tables.not_null(data.messages(spark, sf), "sentiment", "text")
    return rows.select("doc_id", "sentiment")


@query(
    "recode_label",
    f"""SELECT doc_id, CAST(CASE s WHEN 4 THEN 1 WHEN 0 THEN 0 END AS DOUBLE) AS label
        FROM (SELECT d.doc_id, {RAW_LABEL} AS s FROM documents d LEFT JOIN labels l USING (doc_id))
        WHERE s IS NOT NULL""",
)
def recode_label(spark, sf):
    rows = tables.not_null(data.messages(spark, sf), "sentiment")
    label = tables.recode(F.col("sentiment"), {4: 1, 0: 0}).cast("double")
    return rows.select("doc_id", label.alias("label"))


SOCIAL_SQL = (
    "list_filter(regexp_extract_all(lower(text), '"
    + tx.SOCIAL_TOKEN.replace("'", "''")
    + "'), lambda t: NOT starts_with(t, '@') AND NOT starts_with(t, '#') AND NOT starts_with(t, 'http'))"
)


@query(
    "drop_unusable",
    f"""SELECT conv_id, turn, len({SOCIAL_SQL}) AS n_tokens FROM conversations WHERE text IS NOT NULL""",
)
def drop_unusable(spark, sf):
    rows = tables.usable_messages(read_table(spark, sf, "conversations"))
    return rows.select("conv_id", "turn", F.size("tokens").alias("n_tokens"))


@query(
    "row_index",
    "SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS idx FROM documents",
)
def row_index(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    return ordering.dense_index(docs, ["n_chars", "doc_id"]).select("doc_id", "idx")


@query(
    "point_lookup",
    """SELECT doc_id, doc_idx, text FROM (
         SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS doc_idx FROM documents)
       WHERE doc_idx = 131""",
)
def point_lookup(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    ids = tables.point_lookup(docs.select("doc_id"), ["doc_id"], 131)
    return ids.join(docs, "doc_id").select("doc_id", "doc_idx", "text")


@query("docs_by_author", "SELECT doc_id, n_chars FROM documents WHERE lang = 'fr'")
def docs_by_author(spark, sf):
    return read_table(spark, sf, "documents").filter(F.col("lang") == "fr").select("doc_id", "n_chars")


@query(
    "docs_by_length",
    """SELECT doc_id, n AS n_words, CAST(n = 2 AS BIGINT) AS two_words, CAST(n = 3 AS BIGINT) AS three_words,
              CAST(n <= 5 AS BIGINT) AS short, CAST(n <= 150 AS BIGINT) AS ordinary,
              CAST(n > 150 AS BIGINT) AS long
       FROM (SELECT doc_id, len(string_split(text, ' ')) AS n FROM documents)""",
)
def docs_by_length(spark, sf):
    rows = tables.length_classes(data.documents(spark, sf))
    flags = ["two_words", "three_words", "short", "ordinary", "long"]
    return rows.select("doc_id", "n_words", *[F.col(f).cast("int").alias(f) for f in flags])


@query(
    "not_heading",
    parts("sent") + "SELECT doc_id, sent_pos, sentence FROM sent WHERE NOT starts_with(sentence, '==')",
)
def not_heading(spark, sf):
    return tokens.drop_headings(tokens.sentence_rows(data.documents(spark, sf)))


@query(
    "min_tokens",
    parts("clean") + "SELECT doc_id, sent_pos, len(words) AS n_words FROM clean WHERE len(words) > 2",
)
def min_tokens(spark, sf):
    rows = data.clean(spark, sf, min_words=3)
    return rows.select("doc_id", "sent_pos", F.size("words").alias("n_words"))


MASKED = (
    "lower(array_to_string(list_transform(string_split(text, ' '),"
    r" lambda w: CASE WHEN regexp_matches(w, '[^\x00-\x7F]') THEN 'qwerty' ELSE w END), ' '))"
)


def good(expr: str) -> str:
    tokens_sql = rf"regexp_extract_all({expr}, '[A-Za-z0-9]+|[^\sA-Za-z0-9]')"
    return (
        f"list_filter(list_transform({tokens_sql}, lambda t: regexp_replace(t, '[^0-9A-Za-z!?]+', '', 'g')),"
        " lambda t: t <> '')"
    )


@query(
    "nonempty_sentences",
    f"""SELECT doc_id, count(*) AS n_all, count(*) FILTER (WHERE len({good('sentence')}) > 0) AS n_kept
        FROM (SELECT doc_id, unnest(string_split({MASKED}, '.')) AS sentence FROM documents)
        GROUP BY doc_id""",
)
def nonempty_sentences(spark, sf):
    rows = tokens.tokenized_sentences(data.documents(spark, sf))
    return rows.select("doc_id", F.size("all_sentences").alias("n_all"), F.size("sentences").alias("n_kept"))


@query(
    "slice_columns",
    """SELECT vec_id, i AS pos, round(CAST(embedding[i + 2] AS DOUBLE), 6) AS value
       FROM (SELECT vec_id, embedding, unnest(range(8)) AS i FROM embeddings)""",
)
def slice_columns(spark, sf):
    part = vx.slice_columns(F.col("vector"), 2, 8)
    rows = data.embeddings(spark, sf).select("vec_id", F.posexplode(part).alias("pos", "value"))
    return rows.withColumn("value", F.round("value", 6))


@query(
    "binarize",
    """SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos,
              unnest(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1.0::DOUBLE
                     ELSE round(CAST(x AS DOUBLE), 6) END)) AS value
       FROM embeddings""",
)
def binarize(spark, sf):
    rows = data.embeddings(spark, sf).select(
        "vec_id", F.posexplode(vx.binarize(F.col("vector"))).alias("pos", "value")
    )
    return rows.withColumn("value", F.round("value", 6))


@query(
    "label_encode",
    "SELECT doc_id, lang, dense_rank() OVER (ORDER BY lang) - 1 AS label_id FROM documents",
)
def label_encode(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang")
    return tables.label_encode(docs, "lang").select("doc_id", "lang", "label_id")


@query(
    "tag_rows",
    f"""SELECT doc_id, split || '_' || (row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) AS tag
        FROM (SELECT doc_id, {SPLIT} AS split FROM documents)""",
)
def tag_rows(spark, sf):
    docs = tables.holdout_split(read_table(spark, sf, "documents").select("doc_id"), "doc_id")
    return tables.tag_rows(docs, "doc_id").select("doc_id", "tag")


@query("holdout_split", f"SELECT doc_id, {SPLIT} AS split FROM documents")
def holdout_split(spark, sf):
    return tables.holdout_split(read_table(spark, sf, "documents").select("doc_id"), "doc_id")


@query(
    "paste_columns",
    "SELECT d.doc_id, d.lang, d.n_chars, CAST(l.quality AS BIGINT) AS quality, CAST(l.toxic AS BIGINT) AS toxic"
    " FROM documents d JOIN labels l USING (doc_id)",
)
def paste_columns(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return tables.paste_columns(docs, read_table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "lang", "n_chars", "quality", "toxic"
    )


@query(
    "zip_columns",
    parts("lettered")
    + """SELECT s.doc_id, s.sent_pos, length(s.sentence) AS n_chars, len(l.words) AS n_words
         FROM sent s JOIN lettered l USING (doc_id, sent_pos)""",
)
def zip_columns(spark, sf):
    docs = data.documents(spark, sf)
    kept = F.filter(
        F.transform(tx.sentences(F.col("text")), lambda s, i: F.struct(i.alias("pos"), s.alias("s"))),
        lambda p: ~tx.is_heading(p["s"]),
    )
    lists = docs.select("doc_id", kept.alias("kept")).select(
        "doc_id",
        F.transform("kept", lambda p: p["pos"]).alias("sent_pos"),
        F.transform("kept", lambda p: F.length(p["s"])).alias("n_chars"),
        F.transform("kept", lambda p: F.size(tx.split_whitespace(F.lower(tx.letters_only(p["s"]))))).alias("n_words"),
    )
    zipped = F.arrays_zip("sent_pos", "n_chars", "n_words")
    return each_struct(lists, zipped, "sent_pos", "doc_id")


@query("head_cap", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 1000000")
def head_cap(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    return ordering.head(docs, 1_000_000, "doc_id", leading=F.col("doc_id"))


@query("preview", "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 5")
def preview(spark, sf):
    return ordering.head(read_table(spark, sf, "documents").select("doc_id", "lang", "text"), 5, "doc_id")


@query(
    "first_vectors",
    """SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total
       FROM embeddings ORDER BY vec_id LIMIT 1000""",
)
def first_vectors(spark, sf):
    rows = ordering.head(data.embeddings(spark, sf), 1000, "vec_id")
    return rows.select("vec_id", F.round(vx.vector_sum(F.col("vector")), 6).alias("total"))


@query(
    "append_rows",
    """SELECT doc_id AS id, text, 'document' AS kind FROM documents
       UNION ALL SELECT item_id, text, 'benchmark' FROM benchmark""",
)
def append_rows(spark, sf):
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", F.lit("document").alias("kind"))
    items = read_table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text", F.lit("benchmark").alias("kind"))
    return tables.append_rows(docs, items)


@query(
    "union_topics",
    """SELECT regexp_extract(url, '/([a-z]{2})/', 1) AS topic FROM pages
       UNION SELECT lang FROM documents""",
)
def union_topics(spark, sf):
    from_pages = read_table(spark, sf, "pages").select(F.regexp_extract("url", "/([a-z]{2})/", 1).alias("topic"))
    from_docs = read_table(spark, sf, "documents").select(F.col("lang").alias("topic"))
    return tables.append_rows(from_pages, from_docs).distinct()


@query(
    "set_difference",
    parts("tok")
    + r""", conv AS (SELECT DISTINCT unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' ')) AS word
                    FROM conversations)
        SELECT DISTINCT word FROM tok WHERE word NOT IN (SELECT word FROM conv)""",
)
def set_difference(spark, sf):
    asked = tx.split_whitespace(F.lower(tx.letters_only(F.col("text"))))
    conv = each(read_table(spark, sf, "conversations"), asked, "word")
    corpus = tokens.explode_words(data.words(spark, sf)).distinct()
    return tables.difference(corpus, conv.distinct(), "word")


@query("distinct_words", parts("tok") + "SELECT DISTINCT word FROM tok")
def distinct_words(spark, sf):
    return tokens.explode_words(data.words(spark, sf)).distinct()


@query(
    "flatten_sentences",
    f"""SELECT doc_id, count(*) AS n_words, count(DISTINCT word) AS n_distinct
        FROM (SELECT doc_id, unnest({good('sentence')}) AS word
              FROM (SELECT doc_id, unnest(string_split({MASKED}, '.')) AS sentence FROM documents))
        GROUP BY doc_id""",
)
def flatten_sentences(spark, sf):
    rows = tokens.tokenized_sentences(data.documents(spark, sf))
    flat = rows.select("doc_id", F.flatten("sentences").alias("words"))
    return flat.select(
        "doc_id", F.size("words").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct")
    ).filter("n_words > 0")


@query(
    "literal_corpus",
    parts("tok", extra="topics AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{t}')" for i, t in enumerate(INLINE_TOPICS)) + ") v(topic_id, topic))")
    + """SELECT topic_id, topic, count(DISTINCT doc_id) AS n_docs
         FROM (SELECT topic_id, topic, unnest(string_split(topic, ' ')) AS word FROM topics)
         JOIN (SELECT DISTINCT doc_id, word FROM lettered, LATERAL (SELECT unnest(words) AS word)) USING (word)
         GROUP BY topic_id, topic""",
)
def literal_corpus_query(spark, sf):
    """Documents that hold at least one word of each inline topic."""
    topics = literal_corpus(spark, INLINE_TOPICS, "topic_id", "topic")
    single = topics.select("topic_id", "topic", F.explode(tx.split_space(F.col("topic"))).alias("word"))
    docs = tokens.document_words(data.documents(spark, sf), stops=None)
    hits = each(docs, F.array_distinct("words"), "word", "doc_id")
    # the topics are a handful of literals
    pairs = hits.join(F.broadcast(single), "word").select("topic_id", "topic", "doc_id").distinct()
    return pairs.groupBy("topic_id", "topic").agg(F.count("*").alias("n_docs"))


@query(
    "remove_stopwords",
    f"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS ws
                  FROM documents)
        SELECT doc_id, len(ws) AS n_before, len(list_filter(ws, lambda x: x NOT IN ({STOPS}, 'qwerty'))) AS n_after
        FROM w""",
)
def remove_stopwords(spark, sf):
    docs = data.documents(spark, sf).select("doc_id", tx.document_tokens(F.col("text")).alias("ws"))
    stops = [*ENGLISH_STOP_WORDS, tx.MASK_WORD]
    return docs.select(
        "doc_id", F.size("ws").alias("n_before"), F.size(tx.without(F.col("ws"), stops)).alias("n_after")
    )


@query(
    "known_words",
    parts("post", "freq", "nd")
    + """SELECT doc_id, word, n FROM post WHERE word IN
         (SELECT word FROM freq, nd WHERE df >= 15 AND df <= 0.5 * n_docs)""",
)
def known_words(spark, sf):
    rows = data.bags(spark, sf)
    vocab = weights.vocabulary_bounds(rows, min_df=15, max_share=0.5)
    return tables.membership(weights.postings(rows), lookup(vocab.select("word")), "word").select("doc_id", "word", "n")


@query("table_shape", "SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns FROM documents")
def table_shape(spark, sf):
    return stats.table_shape(read_table(spark, sf, "documents"))
