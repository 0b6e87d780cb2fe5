"""Tables from web pages: quotes, glossary terms, body text, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.operators.unnest import each, each_at, each_struct
from corpuslab.session import lookup

_OPEN, _CLOSE = chr(1), chr(2)

# Published names of characters (name character). A hard blank counts as a blank.
NAMED = dict(
    pair.split(" ", 1)
    for pair in (
        "amp &", "lt <", "gt >", 'quot "', "apos '", "nbsp  ", "copy ©", "reg ®", "trade ™", "hellip …", "mdash —",
        "ndash –", "lsquo ‘", "rsquo ’", "sbquo ‚", "ldquo “", "rdquo ”", "bdquo „", "laquo «", "raquo »", "bull •",
        "middot ·", "deg °", "plusmn ±", "times ×", "divide ÷", "euro €", "pound £", "cent ¢", "yen ¥", "sect §",
        "para ¶", "agrave à", "aacute á", "acirc â", "atilde ã", "auml ä", "aring å", "aelig æ", "ccedil ç",
        "egrave è", "eacute é", "ecirc ê", "euml ë", "igrave ì", "iacute í", "icirc î", "iuml ï", "ntilde ñ",
        "ograve ò", "oacute ó", "ocirc ô", "otilde õ", "ouml ö", "oslash ø", "oelig œ", "ugrave ù", "uacute ú",
        "ucirc û", "uuml ü", "szlig ß", "Agrave À", "Aacute Á", "Auml Ä", "Aring Å", "Ccedil Ç", "Egrave È",
        "Eacute É", "Ntilde Ñ", "Oacute Ó", "Ouml Ö", "Oslash Ø", "Uacute Ú", "Uuml Ü", "iexcl ¡", "iquest ¿",
    )
)
# What follows the ampersand of a character reference.
REFERENCE = "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"
# Elements without an end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<head[^>]*>.*?</head>"


def unescape(text: Column) -> Column:
    """Character references read once: by number, decimal or hexadecimal, and by the published names.

    A number that is no character gives the replacement character; an unknown
    name stays as it is.
    """
    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def after_mark(piece: Column, i: Column) -> Column:
        name = F.regexp_extract(piece, REFERENCE, 1)
        digits = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)).when(
            name.startswith("#"), F.substring(name, F.lit(2), F.length(name))
        )
        number = digits.cast("bigint")
        exists = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        written = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        found = F.when(number == 160, " ").when(exists, written).when(number.isNotNull(), "\ufffd").otherwise(
            F.try_element_at(names, name)
        )
        rest = F.substring(piece, F.length(name) + 2, F.length(piece))
        return F.when(i == 0, piece).otherwise(F.coalesce(F.concat(found, rest), F.concat(F.lit("&"), piece)))

    return F.array_join(F.transform(F.split(text, "&"), after_mark), "")


def strip_tags(html: Column) -> Column:
    plain = unescape(F.regexp_replace(html, "<[^>]*>", " "))
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def page_text(pages: DataFrame) -> DataFrame:
    """Visible text of each page."""
    visible = F.regexp_replace("html", HIDDEN, " ")
    return pages.select("page_id", "url", strip_tags(visible).alias("text"))


def _first(html: Column, tag: str, css_class: str | None = None) -> Column:
    attributes = f'[^>]*class="{css_class}"[^>]*' if css_class else "[^>]*"
    return F.regexp_extract(html, rf"(?is)<{tag}{attributes}>(.*?)</{tag}>", 1)


def page_quotes(
    pages: DataFrame, name_class: str | None = None, price_class: str | None = "price"
) -> DataFrame:
    """First heading, title and price of each page; null where absent."""
    html = F.col("html")

    def field(tag: str, css_class: str | None = None) -> Column:
        return F.nullif(strip_tags(_first(html, tag, css_class)), F.lit(""))

    return pages.select(
        "page_id",
        "url",
        field("h1", name_class).alias("name"),
        field("title").alias("title"),
        field("div", price_class).alias("price"),
    )


def page_links(pages: DataFrame, n: int | None = None) -> DataFrame:
    """(page_id, pos, link) in page order, the first ``n`` of each page."""
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    if n is not None:
        links = F.slice(links, 1, n)
    return each_at(pages, links, "pos", "link", "page_id")


def _opened(html: Column) -> Column:
    """What follows the start of each paragraph, up to the start of the next; its end is marked."""
    visible = F.regexp_replace(html, HIDDEN, " ")
    marked = F.regexp_replace(visible, r"(?i)<p(\s[^>]*)?>", _OPEN)
    marked = F.regexp_replace(marked, r"(?i)</p>", _CLOSE)
    pieces = F.split(marked, _OPEN)
    return F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))


def _paragraph(piece: Column) -> Column:
    return strip_tags(F.split_part(piece, F.lit(_CLOSE), F.lit(1)))


def paragraphs(html: Column) -> Column:
    """Text of each paragraph; an unclosed one ends where the next begins."""
    return F.transform(_opened(html), _paragraph)


def next_sibling(pieces: Column, i: Column) -> Column:
    """Text of the node after the i-th paragraph: text that follows it, an element, or the next paragraph.

    Null where the parent ends first. An element is read up to its end tag or
    the next paragraph; one without an end tag has no text.
    """
    piece = F.get(pieces, i)
    after = F.substring(piece, F.length(F.split_part(piece, F.lit(_CLOSE), F.lit(1))) + 2, F.length(piece))
    lead = strip_tags(F.regexp_extract(after, "^[^<\\x02]*", 0))
    rest = F.regexp_replace(after, r"^\s+", "")
    tag = F.lower(F.regexp_extract(rest, "^<([A-Za-z][A-Za-z0-9]*)", 1))
    body = F.split_part(F.lower(rest), F.concat(F.lit("</"), tag), F.lit(1))
    element = F.when(tag.isin(*VOID), "").otherwise(strip_tags(F.substring(rest, F.lit(1), F.length(body))))
    following = F.get(pieces, i + 1)
    return F.when(lead != "", lead).when(rest == "", _paragraph(following)).when(tag != "", element)


def page_glossary(pages: DataFrame) -> DataFrame:
    """(page_id, pos, term, description): each paragraph with the node that follows it.

    A paragraph without a next sibling is dropped. Neighbours are paired inside
    the page's row, so nothing is windowed.
    """
    rows = pages.select("page_id", _opened(F.col("html")).alias("ps"))
    pairs = F.transform(
        "ps", lambda p, i: F.struct(i.alias("pos"), _paragraph(p).alias("term"), next_sibling(F.col("ps"), i).alias("description"))
    )
    return each_struct(rows, F.filter(pairs, lambda x: x["description"].isNotNull()), "term", "page_id")


def title_words(titles: DataFrame, key: str = "page_id", title: str = "title") -> DataFrame:
    """(word, titles, best_title, best_key): one row per word of any title.

    ``best`` is the title with the lowest key, kept by aggregation, so a word
    that occurs in most titles is still one row.
    """
    words = F.array_distinct(tx.split_whitespace(F.lower(tx.letters_only(F.col(title)))))
    return (
        each(titles, words, "word", key, title)
        .groupBy("word")
        .agg(
            F.count("*").alias("titles"),
            F.min(F.struct(F.col(key).alias("key"), F.col(title).alias("title"))).alias("best"),
        )
        .select("word", "titles", F.col("best.title").alias("best_title"), F.col("best.key").alias("best_key"))
    )


def match_title(terms: DataFrame, titles: DataFrame, keys: list[str], term: str = "term") -> DataFrame:
    """Single best title for each term; empty when no word of it is in a title.

    A term is looked up by its rarest title word, and that word by its first
    title: each word of the term meets one row, whatever its frequency.
    """
    index = title_words(titles)
    words = F.array_distinct(tx.split_whitespace(F.lower(tx.letters_only(F.col(term)))))
    # only keys and words travel; the term's text stays with its own row
    found = each(terms, words, "word", *keys).join(lookup(index), "word")
    hit = F.struct("titles", "word", "best_title", "best_key")
    best = found.groupBy(*keys).agg(F.min(hit).alias("b"))
    return terms.select(*keys, term).join(best, keys, "left").select(
        *keys,
        term,
        F.coalesce("b.best_title", F.lit("")).alias("title"),
        F.col("b.best_key").alias("title_key"),
    )


def retrieval_counts(matched: DataFrame) -> DataFrame:
    """Lookups that ran, lookups that found a title, and terms."""
    return matched.agg(
        F.count("term").alias("n_retrieved"),
        F.count_if(F.col("title") != "").alias("n_matched"),
        F.count("*").alias("n_terms"),
    )


def not_yet_stored(articles: DataFrame, stored: DataFrame, title: str = "title") -> DataFrame:
    return articles.join(stored.select(title).distinct(), title, "left_anti")


def expand_links(
    seeds: DataFrame,
    links: DataFrame,
    articles: DataFrame,
    stored: DataFrame,
    n: int = 30,
    expand_all: bool = False,
) -> DataFrame:
    """(title, via, content): seed articles and the articles they link to.

    ``seeds`` (title, traverse); ``links`` (title, pos, target); ``articles``
    (title, content); ``stored`` (title). A seed that is already stored is read,
    not expanded, unless ``expand_all``. Linked articles already stored or
    without a page are left out; each remaining article appears once.
    """
    fresh = seeds if expand_all else not_yet_stored(seeds, stored)
    expanded = fresh if expand_all else fresh.filter("traverse")
    targets = (
        expanded.select("title").join(links.filter(F.col("pos") < n), "title")
        .groupBy(F.col("target").alias("title"))
        .agg(F.min("title").alias("via"))
    )
    wanted = not_yet_stored(targets, stored).join(seeds.select("title"), "title", "left_anti")
    rows = seeds.select("title", F.lit("").alias("via")).unionByName(wanted)
    return rows.join(articles, "title")
