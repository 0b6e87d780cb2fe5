from corpuslab.operators import web

PAGE = (
    '<html><head><title>A &amp; B</title><style>p{}</style></head><body><script>var t="</p><p>no</p>";</script>'
    '<h1 class="name"> Index\n</h1><div class="price">1,234</div>'
    "<p>First</p><p>Second <b>bold</b><p>Third &lt;x&gt;</p>"
    + "".join(f'<a href="/l{i}">l{i}</a>' for i in range(50))
    + "</body></html>"
)


def pages(spark):
    return spark.createDataFrame([(1, "u1", PAGE), (2, "u2", "<p>only</p>")], "page_id long, url string, html string")


def test_quotes(spark):
    got = {r["page_id"]: (r["name"], r["title"], r["price"]) for r in web.page_quotes(pages(spark), "name").collect()}
    assert got == {1: ("Index", "A & B", "1,234"), 2: (None, None, None)}


def test_glossary_pairs_and_drops_last(spark):
    rows = web.page_glossary(pages(spark)).orderBy("page_id", "pos").collect()
    assert [(r["page_id"], r["term"], r["description"]) for r in rows] == [
        (1, "First", "Second bold"), (1, "Second bold", "Third <x>"), (1, "Third <x>", "l0")
    ]


def test_any_next_sibling_is_paired(spark):
    html = (
        "<div><p>a</p> text &mdash; here <b>x</b><p>b</p>\n<div class='q'>an <i>element</i></div><p>c</p><br>after"
        "<p>d<p>e</p></div><p>f</p> <!-- note --> <P id=1>g</P>\n"
    )
    rows = web.page_glossary(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("pos").collect()
    assert [(r["pos"], r["term"], r["description"]) for r in rows] == [
        (0, "a", "text — here"), (1, "b", "an element"), (2, "c", ""), (3, "d", "e"), (5, "f", "g")
    ]


def test_character_references(value):
    said = {
        "&mdash;&#8217;&#x2019;&#X1F600;": "—’’😀", "a &amp;lt; b": "a &lt; b", "&nbsp;|&#160;|": " | |", "&unknown; & &; &#;": "&unknown; & &; &#;",
        "&#0;&#55296;&#9999999;": "\ufffd" * 3, "&eacute;t&eacute;&ETH": "été&ETH", "": "", "&&amp;": "&&",
    }
    for text, want in said.items():
        assert value(web.unescape, text) == want
    assert value(web.unescape, None) is None


def test_text_hides_scripts(spark):
    text = web.page_text(pages(spark)).filter("page_id = 1").first()["text"]
    assert "var t" not in text and "A & B" not in text and text.startswith("Index 1,234 First")


def test_links_are_cut_at_n(spark):
    assert web.page_links(pages(spark), 40).count() == 40
    assert web.page_links(pages(spark)).count() == 50


def test_match_title_takes_rarest_word(spark):
    titles = spark.createDataFrame([(1, "The bank"), (2, "The loan"), (3, "the the")], "page_id long, title string")
    terms = spark.createDataFrame([(0, "The Loan rate"), (1, "the"), (2, "zebra"), (3, "")], "t long, term string")
    got = {r["t"]: r["title"] for r in web.match_title(terms, titles, ["t"]).collect()}
    assert got == {0: "The loan", 1: "The bank", 2: "", 3: ""}
    counts = web.retrieval_counts(web.match_title(terms, titles, ["t"])).first()
    assert (counts["n_retrieved"], counts["n_matched"], counts["n_terms"]) == (4, 2, 4)


def test_expand_links(spark):
    seeds = spark.createDataFrame([("A", True), ("B", False), ("C", True)], "title string, traverse boolean")
    links = spark.createDataFrame(
        [("A", 0, "X"), ("A", 1, "Y"), ("A", 30, "Z"), ("A", 2, "B"), ("A", 3, "gone"), ("B", 0, "W"), ("C", 0, "V"), ("A", 4, "old")],
        "title string, pos int, target string",
    )
    articles = spark.createDataFrame([(t, t.lower()) for t in "ABCWXYZV"] + [("old", "o")], "title string, content string")
    stored = spark.createDataFrame([("C",), ("old",)], "title string")
    got = {r["title"]: r["via"] for r in web.expand_links(seeds, links, articles, stored).collect()}
    # C is stored: read, not expanded; B is plain; Z lies past the thirtieth link
    assert got == {"A": "", "B": "", "C": "", "X": "A", "Y": "A"}
    every = {r["title"] for r in web.expand_links(seeds, links, articles, stored, expand_all=True).collect()}
    assert every == {"A", "B", "C", "X", "Y", "V", "W"}
