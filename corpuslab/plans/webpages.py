"""Page tables, link expansion and title lookup (survey A12-A15, D6, D8, D9, E21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslab.operators import web
from corpuslab.operators.unnest import each_at
from corpuslab.plans import data
from corpuslab.plans.registry import query
from corpuslab.sources.writers import article_name

_HIDDEN = web.HIDDEN


_NAMES = "map {" + ", ".join(f"'{k}': '{v.replace(chr(39), chr(39) * 2)}'" for k, v in web.NAMED.items()) + "}"
_REF = f"regexp_extract(p, '{web.REFERENCE}', 1)"
_CODE = (
    f"CASE WHEN regexp_matches({_REF}, '^#[xX]') THEN CAST('0x' || substr({_REF}, 3) AS BIGINT)"
    f" WHEN starts_with({_REF}, '#') THEN CAST(substr({_REF}, 2) AS BIGINT) END"
)
_CHARACTER = (
    f"CASE WHEN {_CODE} IS NULL THEN {_NAMES}[{_REF}] WHEN {_CODE} = 160 THEN ' '"
    f" WHEN {_CODE} BETWEEN 1 AND 55295 OR {_CODE} BETWEEN 57344 AND 1114111 THEN chr(CAST({_CODE} AS INTEGER))"
    " ELSE chr(65533) END"
)


def _unescape(expr: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({expr}, '&'), lambda p, i: CASE WHEN i = 1 THEN p"
        f" ELSE coalesce({_CHARACTER} || substr(p, length({_REF}) + 2), '&' || p) END), '')"
    )


def _strip(expr: str) -> str:
    out = _unescape(f"regexp_replace({expr}, '<[^>]*>', ' ', 'g')")
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def _field(tag: str) -> str:
    return f"nullif({_strip(f'''regexp_extract(html, '(?is)<{tag}[^>]*>(.*?)</{tag}>', 1)''')}, '')"


_VISIBLE = f"regexp_replace(html, '{_HIDDEN}', ' ', 'g')"
_TITLES = f"titles AS (SELECT page_id, url, coalesce({_field('title')}, '') AS title FROM pages)"
_PARAS = rf"""marked AS (SELECT page_id, regexp_replace(regexp_replace({_VISIBLE}, '(?i)<p(\s[^>]*)?>', chr(1), 'g'),
                  '(?i)</p>', chr(2), 'g') AS h FROM pages),
    paras AS (SELECT page_id, generate_subscripts(ps, 1) - 1 AS pos, unnest(ps) AS p FROM (
        SELECT page_id, string_split(h, chr(1))[2:] AS ps FROM marked)),
    texts AS (SELECT page_id, pos, {_strip("split_part(q, chr(2), 1)")} AS p, q,
                     substr(q, length(split_part(q, chr(2), 1)) + 2) AS after
              FROM (SELECT page_id, pos, p AS q FROM paras)),
    behind AS (SELECT *, regexp_replace(after, '^\s+', '') AS rest,
                      lead(p) OVER (PARTITION BY page_id ORDER BY pos) AS nxt FROM texts),
    tagged AS (SELECT *, lower(regexp_extract(rest, '^<([A-Za-z][A-Za-z0-9]*)', 1)) AS tag,
                      {_strip("regexp_extract(after, '^[^<' || chr(2) || ']*', 0)")} AS lead_text FROM behind),
    siblings AS (SELECT page_id, pos, p AS term, CASE WHEN lead_text <> '' THEN lead_text WHEN rest = '' THEN nxt
                     WHEN tag = '' THEN NULL WHEN tag IN ({", ".join(f"'{v}'" for v in web.VOID)}) THEN ''
                     ELSE {_strip("substr(rest, 1, length(split_part(lower(rest), '</' || tag, 1)))")} END AS description
                 FROM tagged),
    glossary AS (SELECT * FROM siblings WHERE description IS NOT NULL)"""


@query(
    "page_quotes",
    f"""SELECT page_id, url, {_field('h1')} AS name, {_field('title')} AS title, CAST(NULL AS VARCHAR) AS price
        FROM pages""",
)
def page_quotes(spark, sf):
    return web.page_quotes(data.pages(spark, sf))


@query("page_glossary", f"WITH {_PARAS} SELECT page_id, pos, term, description FROM glossary")
def page_glossary(spark, sf):
    return web.page_glossary(data.pages(spark, sf))


@query(
    "next_element",
    f"""WITH {_PARAS} SELECT page_id, pos, md5(p) AS this, md5(coalesce(nxt, '')) AS following FROM (
        SELECT page_id, pos, p, lead(p) OVER (PARTITION BY page_id ORDER BY pos) AS nxt FROM texts)""",
)
def next_element(spark, sf):
    """Every paragraph beside the next one; the last has an empty neighbour."""
    rows = data.pages(spark, sf).select("page_id", web.paragraphs(F.col("html")).alias("ps"))
    single = each_at(rows, "ps", "pos", "p", "page_id", "ps")
    after = F.coalesce(F.get("ps", F.col("pos") + 1), F.lit(""))
    return single.select("page_id", "pos", F.md5("p").alias("this"), F.md5(after).alias("following"))


@query("page_text", f"SELECT page_id, url, {_strip(_VISIBLE)} AS text FROM pages")
def page_text(spark, sf):
    return web.page_text(data.pages(spark, sf))


_LINKS = """links AS (SELECT page_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS link FROM (
    SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages))"""


@query("page_links", f"WITH {_LINKS} SELECT page_id, pos, link FROM links")
def page_links(spark, sf):
    return web.page_links(data.pages(spark, sf))


@query("first_links", f"WITH {_LINKS} SELECT page_id, pos, link FROM links WHERE pos < 30")
def first_links(spark, sf):
    return web.page_links(data.pages(spark, sf), 30)


def _words_sql(expr: str) -> str:
    return (
        f"list_distinct(list_filter(string_split(lower(regexp_replace({expr}, '[^a-zA-Z]', ' ', 'g')), ' '),"
        " lambda w: w <> ''))"
    )


_INDEX = f"""tw AS (SELECT page_id, title, unnest({_words_sql('title')}) AS word FROM titles),
    tindex AS (SELECT word, count(*) AS titles, min(page_id) AS best_key FROM tw GROUP BY word)"""
_MATCHED = f"""gw AS (SELECT page_id, pos, unnest({_words_sql('term')}) AS word FROM glossary),
    gr AS (SELECT g.page_id, g.pos, i.best_key, row_number() OVER (PARTITION BY g.page_id, g.pos
               ORDER BY i.titles, g.word) AS r FROM gw g JOIN tindex i USING (word)),
    matched AS (SELECT g.page_id, g.pos, g.term, coalesce(t.title, '') AS title, b.best_key AS title_key
        FROM glossary g LEFT JOIN (SELECT * FROM gr WHERE r = 1) b USING (page_id, pos)
        LEFT JOIN titles t ON t.page_id = b.best_key)"""


def _matched(spark, sf):
    terms = web.page_glossary(data.pages(spark, sf))
    return web.match_title(terms, data.page_titles(spark, sf), ["page_id", "pos"])


@query(
    "match_title",
    f"WITH {_TITLES}, {_PARAS}, {_INDEX}, {_MATCHED}"
    " SELECT page_id, pos, md5(term) AS term, title, CAST(title_key AS DOUBLE) AS title_key FROM matched",
)
def match_title(spark, sf):
    return _matched(spark, sf).withColumns(
        {"term": F.md5("term"), "title_key": F.col("title_key").cast("double")}
    )


@query(
    "retrieval_counts",
    f"""WITH {_TITLES}, {_PARAS}, {_INDEX}, {_MATCHED}
        SELECT count(term) AS n_retrieved, count(*) FILTER (WHERE title <> '') AS n_matched, count(*) AS n_terms
        FROM matched""",
)
def retrieval_counts(spark, sf):
    return web.retrieval_counts(_matched(spark, sf))


# Articles already fetched: the pages served from a mobile host.
_STORED = "stored AS (SELECT DISTINCT title FROM titles WHERE contains(url, '//m.'))"


def _stored(titles):
    return titles.filter(F.col("url").contains("//m.")).select("title").distinct()


@query(
    "not_yet_stored",
    f"WITH {_TITLES}, {_STORED} SELECT page_id, title FROM titles WHERE title NOT IN (SELECT title FROM stored)",
)
def not_yet_stored(spark, sf):
    titles = data.page_titles(spark, sf)
    return web.not_yet_stored(titles.select("page_id", "title"), _stored(titles))


_EXPAND = f"""first_page AS (SELECT title, min(page_id) AS page_id FROM titles GROUP BY title),
    seeds AS (SELECT DISTINCT t.title, contains(t.url, 'http://') AS traverse FROM titles t
              JOIN first_page f ON f.page_id = t.page_id WHERE contains(t.url, '/en/')),
    outgoing AS (SELECT f.title, l.pos, i.best_key FROM first_page f JOIN links l USING (page_id)
                 JOIN tindex i ON i.word = lower(regexp_replace(l.link, '[^a-zA-Z]', '', 'g'))),
    body AS (SELECT f.title, {_strip(_VISIBLE)} AS content FROM first_page f JOIN pages USING (page_id)),
    target AS (SELECT t.title, min(o.title) AS via FROM outgoing o JOIN titles t ON t.page_id = o.best_key
               JOIN seeds s ON s.title = o.title WHERE o.pos < 30 AND %s GROUP BY t.title)"""


def _expand_sql(condition: str) -> str:
    return f"""WITH {_TITLES}, {_STORED}, {_LINKS}, {_INDEX}, {_EXPAND % condition}
        SELECT title, via, md5(content) AS content FROM (
            SELECT title, '' AS via FROM seeds
            UNION ALL SELECT title, via FROM target WHERE title NOT IN (SELECT title FROM stored)
                AND title NOT IN (SELECT title FROM seeds)) JOIN body USING (title)"""


def _expansion(spark, sf, expand_all):
    """Topics are the English pages; the articles they link to may be any."""
    titles = data.page_titles(spark, sf)
    pages = data.pages(spark, sf)
    first = titles.groupBy("title").agg(F.min_by(F.struct("page_id", "url"), "page_id").alias("p")).select(
        "title", "p.page_id", "p.url"
    )
    seeds = first.filter(F.col("url").contains("/en/")).select(
        "title", F.col("url").contains("http://").alias("traverse")
    )
    index = web.title_words(titles).select(F.col("word"), F.col("best_title").alias("target"))
    named = web.page_links(pages).withColumn("word", F.lower(F.regexp_replace("link", "[^a-zA-Z]", "")))
    links = named.join(index, "word").join(first.select("title", "page_id"), "page_id").select("title", "pos", "target")
    bodies = web.page_text(pages).select("page_id", F.col("text").alias("content"))
    articles = first.select("title", "page_id").join(bodies, "page_id").select("title", "content")
    rows = web.expand_links(seeds, links, articles, _stored(titles), 30, expand_all)
    return rows.withColumn("content", F.md5("content"))


@query(
    "expand_links",
    _expand_sql("s.traverse AND s.title NOT IN (SELECT title FROM stored)"),
)
def expand_links(spark, sf):
    """English topics: flagged ones not yet stored bring in their first 30 links."""
    return _expansion(spark, sf, expand_all=False)


@query("expand_all_links", _expand_sql("TRUE"))
def expand_all_links(spark, sf):
    """Every English topic brings in its links, stored or not."""
    return _expansion(spark, sf, expand_all=True)


@query(
    "sanitize_name",
    f"""WITH {_TITLES} SELECT page_id, '--' || regexp_replace(title, '[^A-Za-z0-9 ]+', '', 'g') || '--' AS topic_name,
        regexp_replace(title, '[^A-Za-z0-9 ]+', '', 'g') || '_' || regexp_replace(url, '[^A-Za-z0-9]+', '', 'g') AS link_name
        FROM titles""",
)
def sanitize_name(spark, sf):
    titles = data.page_titles(spark, sf)
    return titles.select(
        "page_id",
        article_name(F.col("title")).alias("topic_name"),
        article_name(F.col("title"), F.col("url")).alias("link_name"),
    )


@query(
    "trim_and_label",
    f"""WITH {_TITLES} SELECT page_id, 'PAGE_' || page_id AS label, length(trim(title)) AS n_chars,
        CAST(starts_with(url, 'https') AS BIGINT) AS secure FROM titles""",
)
def trim_and_label(spark, sf):
    titles = data.page_titles(spark, sf)
    return titles.select(
        "page_id",
        F.concat_ws("_", F.lit("PAGE"), F.col("page_id")).alias("label"),
        F.length(F.trim("title")).alias("n_chars"),
        F.col("url").startswith("https").cast("int").alias("secure"),
    )
