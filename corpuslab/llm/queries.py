"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.llm import (
    decontam, interaction, minhash, packing, passages, pii, quality, store, substrings, tokenfiles, toxicity, trie,
    urlfilter, wrappers,
)
from corpuslab.session import lookup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_quality_rules(spark, sf_dir):
    """Counts and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words",
        "q.base_failed", "q.kept", "q.n_stop_words", "q.n_lines", "q.n_ellipsis_lines", "q.n_bullet_lines",
    )


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _words_sql() -> str:
    return r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality_sql() -> str:
    stops = sorted({w for line in quality.STOP_WORDS.values() for w in line.split()})
    listed = ", ".join(f"'{w}'" for w in stops)
    symbols = quality.SYMBOLS
    tests = []
    for r in quality.RULES:
        if r.least is not None:
            tests.append(f"100 * {r.part} >= {r.least} * {r.whole}")
        if r.most is not None:
            tests.append(f"100 * {r.part} <= {r.most} * {r.whole}")
    return rf"""WITH base AS (
        SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text, {_words_sql()} AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    windows AS (SELECT row_no, unnest(range(1, len(words) - 1)) AS i, words FROM base WHERE len(words) >= 3),
    twins AS (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, words[i], words[i + 1], words[i + 2]) AS n
              FROM windows),
    covered AS (SELECT row_no, count(DISTINCT p) AS n_repeat_words
                FROM (SELECT row_no, unnest([i, i + 1, i + 2]) AS p FROM twins WHERE n > 1) GROUP BY row_no),
    counts AS (
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
               CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
               CAST(length(text) - length(translate(text, '{symbols}', '')) AS BIGINT) AS n_symbols,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
               CAST(len(list_filter(words, lambda w: lower(w) IN ({listed}))) AS BIGINT) AS n_stop_words,
               CAST(len(lines) AS BIGINT) AS n_lines,
               CAST(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS BIGINT)
                   AS n_ellipsis_lines,
               CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS BIGINT)
                   AS n_bullet_lines
        FROM base LEFT JOIN covered USING (row_no)),
    judged AS (SELECT *, n_words < {quality.LEAST_WORDS}
                         OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed
               FROM counts)
    SELECT *, NOT base_failed AND {' AND '.join(tests)} AS kept FROM judged"""


ORACLES["op3_quality_rules"] = _quality_sql()


@_query
def op4_substring_dedup(spark, sf_dir):
    """Words of every document that no earlier document's 50-word windows cover."""
    return substrings.repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


@_query
def op9_url_filters(spark, sf_dir):
    """Verdict on the address of every page; a page's label is that of the document its address names."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(urlfilter.path_of(F.col("url")), "/([0-9]{1,18})(\\.html)?/?$", 1)
    labels = (
        pages.select("page_id", F.when(number != "", number.cast("bigint")).alias("doc_id"))
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select("page_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    )
    return urlfilter.judge(pages, labels)


@_query
def op6_token_files(spark, sf_dir):
    """Ids of every document, written to token files and read back from them."""
    path = store.new_path(spark, "token-files")
    tokenfiles.write(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=1)
    return tokenfiles.read(spark, path, digest=True)


@_query
def op8_best_fit_packing(spark, sf_dir):
    """Place of every piece of every document in sequences of 2048 tokens."""
    pieces = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)
    return packing.pack(pieces)


@_query
def op10_personal_data(spark, sf_dir):
    """Counts, digest and spans of the personal data in every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", pii.span_text(F.col("spans")).alias("spans")
    )


@_query
def op5_decontamination(spark, sf_dir):
    """Documents that hold a benchmark passage, with the item and the extent of the overlap."""
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op7_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    labelled = docs.filter(F.octet_length("text") <= toxicity.Settings.most_bytes).join(lookup(labels), "doc_id")
    model = toxicity.train(labelled.withColumnRenamed("doc_id", "key"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@_query
def op1_minhash_near_dedup(spark, sf_dir):
    """Group of near copies of every document."""
    groups = minhash.duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "class_id", "n_copies", "kept")


@_query
def op2_main_text(spark, sf_dir):
    """Main text of every page."""
    return wrappers.main_text(table(spark, sf_dir, "pages"))


@_query
def op11_filter_interaction(spark, sf_dir):
    """What each of five filters removes from every source, in every order."""
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op11_filter_interaction"] = rf"""WITH RECURSIVE base AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_words_sql()} AS words FROM documents),
    first AS (SELECT text, min(doc_id) AS first_id FROM base GROUP BY text),
    known AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    docs AS (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
               list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
                   WHEN 'A' THEN len(words) < 50
                   WHEN 'B' THEN 100 * len(list_distinct(words)) < 65 * len(words)
                   WHEN 'C' THEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text)
                   WHEN 'D' THEN regexp_matches(text, '[#$%&*|]')
                   ELSE coalesce(doc_id > first_id, false) END) AS fails
        FROM base JOIN first USING (text) LEFT JOIN known USING (doc_id)),
    cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
              FROM docs GROUP BY part, fails),
    orders AS (
        SELECT '' AS filter_order, ['A', 'B', 'C', 'D', 'E'] AS rest
        UNION ALL
        SELECT filter_order || f, list_filter(rest, lambda x: x <> f) FROM (SELECT *, unnest(rest) AS f FROM orders)),
    steps AS (SELECT filter_order, step, filter_order[step] AS f,
                     list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: contains(filter_order[1:step - 1], x)) AS earlier
              FROM orders, range(1, 6) AS r(step) WHERE len(rest) = 0),
    played AS (
        SELECT part, filter_order, step, f,
               coalesce(sum(n) FILTER (NOT list_has_any(fails, earlier || [f])), 0) AS kept,
               coalesce(sum(n) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, earlier)), 0) AS removed,
               coalesce(sum(n) FILTER (list_contains(fails, f) AND list_has_any(fails, earlier)), 0) AS redundant,
               coalesce(sum(n) FILTER (fails = [f]), 0) AS unique_fails,
               coalesce(sum(good) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, earlier)), 0) AS good_lost,
               coalesce(sum(toxic) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, earlier)), 0)
                   AS toxic_lost
        FROM cells, steps GROUP BY ALL)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
           CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
           CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
    FROM played"""


@_query
def op12_conversation_trie(spark, sf_dir):
    """Nodes of the prefix trie of all rebuilt conversations."""
    return trie.trie(table(spark, sf_dir, "conversations"))


# the reflected CRC-32, one step for each character and eight for its bits
_CRC32_SQL = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] "
    "FOR ch IN string_split(conv_id::VARCHAR, '')])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
    "ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"
)

ORACLES["op12_conversation_trie"] = rf"""WITH t AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, ''))
                   AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    own AS (SELECT conv_id, conv_id - conv_id % 20 AS base_id, {_CRC32_SQL} % 4 AS h, count(*) AS turns
            FROM t GROUP BY conv_id),
    plan AS (SELECT o.conv_id, o.base_id, o.h, least(o.h, coalesce(b.turns, 0)) AS k,
                    least(o.h, coalesce(b.turns, 0)) + greatest(o.turns - o.h, 0) AS length
             FROM own o LEFT JOIN own b ON b.conv_id = o.base_id),
    rebuilt AS (
        SELECT p.conv_id, t.pos AS depth, role, text FROM plan p JOIN t ON t.conv_id = p.base_id AND t.pos <= p.h
        UNION ALL
        SELECT p.conv_id, t.pos - p.h + p.k, role, text FROM plan p JOIN t ON t.conv_id = p.conv_id AND t.pos > p.h),
    prefixes AS (
        SELECT conv_id, 0 AS depth, CAST([] AS STRUCT(role VARCHAR, text VARCHAR)[]) AS path, 0 AS n_words FROM plan
        UNION ALL
        SELECT conv_id, depth, list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY depth),
               len({_words_sql()})
        FROM rebuilt),
    nodes AS (
        SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_words) AS n_words,
               count(*) FILTER (depth = length) AS n_ends,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), ''))
                   AS ends_sha256
        FROM prefixes JOIN plan USING (conv_id) GROUP BY depth, path),
    children AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes
                 WHERE depth > 0 GROUP BY ALL),
    below AS (
        SELECT p.depth, p.path, count(*) FILTER (m.n_ends = m.n_convs) AS n_leaves,
               sum((m.n_convs - 1) * m.n_words) AS saved_tokens
        FROM nodes m JOIN prefixes p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY p.depth, p.path)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs,
           coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN below b ON b.depth = n.depth AND b.path = n.path
    LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
    LEFT JOIN nodes u ON n.depth > 0 AND u.depth = n.depth - 1 AND u.path = n.path[1:n.depth - 1]"""


@_query
def op13_quality_classifier(spark, sf_dir):
    """Quality of every document, learnt from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", (F.col("quality") == 1).alias("good"))
    return passages.score(docs, passages.train(docs, labels)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
