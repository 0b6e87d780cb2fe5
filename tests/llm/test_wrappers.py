"""Main text of pages: odd markup, layouts with and without names, and the test table."""

import html
import json
import re

import pytest

from corpuslab.llm import wrappers as wr
from corpuslab.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def one(page, *others):
    w = wr.wrapper_of(wr.parse(page))
    for p in others:
        w = wr.align(w, wr.wrapper_of(wr.parse(p)))
    return wr.text_of(wr.parse(page), *wr.reading(w))


def page(i, words="Some words of the text"):
    return f"""<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style></head><body class="home page-{i}">
    <header id="masthead"><a href="/">Site</a><form><input><button>Go</button></form></header>
    <nav class="menu"><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
    <div id="cookie-notice"><p>We use cookies number {i}</p></div>
    <div class="layout"><div class="sidebar"><h3>More</h3><ul><li><a href="/{i}">other {i}</a></li></ul></div>
    <div class="post-{i}"><article class="post"><header><h1>Title {i}</h1></header>
    <p>{words} {i} &amp; caf&eacute; &#8212; &#x41;<br>after   a
    break</p><aside class="ad">Buy {i}</aside><p>Second <b>bold</b> <a href="x">link</a>.
    <ul><li>one<li>two</ul><script>var s="<p>no</p>";</script><!-- no <p>comment</p> -->
    <table><tr><td>c1<td>c2</tr></table>
    <div class="share-buttons">Share {i}</div></article>
    <section id="comments"><h2>Comments</h2><article class="comment"><p>{"I disagree with all of that " * 50}</p></article></section>
    </div></div><footer>&copy; {i}</footer></body></html>"""


WANT = "Title {i}\nSome words of the text {i} & café — A after a break\nSecond bold link.\none\ntwo\nc1\nc2"


@pytest.mark.parametrize("n", [1, 2, 12])
def test_named_layout(n):
    pages = [page(i) for i in range(n)]
    assert one(pages[0], *pages[1:]) == WANT.format(i=0)


def plain(i):
    return f"""<html><body><div><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></div>
    <div><h1>Head {i}</h1><p>{f"word{i} " * 40}</p><p>{f"more{i} " * 30}</p></div>
    <div class=strap>Same line on every page</div></body></html>"""


def test_layout_without_names():
    pages = [plain(i) for i in range(12)]
    got = one(pages[3], *pages[:3], *pages[4:])
    assert got == f"Head 3\n{('word3 ' * 40).strip()}\n{('more3 ' * 30).strip()}"


@pytest.mark.parametrize("markup,text", [
    ("", ""), ("just text", "just text"), ("a < b and c<d>e", "a < b and ce"), ("<p>a<p>b", "a\nb"), ("<p>a</p", "a"),
    ("<p title='x>y'>a</p>", "a"), ("<p class=\"open>a</p><p>b</p>", "a\nb"), ("<!-- never closed <p>a", ""),
    ("<script>never closed <p>a", ""), ("a<!doctype html>b", "ab"), ("<b>x<i>y</b>z</i>", "xyz"), ("</p>a</div></x>", "a"),
    ("<div>a<hr>b</div>", "a\nb"), ("<P>&lt;p&gt; &amp;amp; &nbsp;&unknown; &#0;x", "<p> &amp; &unknown; �x"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"), ("<p hidden>x</p><p style='display: none'>y</p><p>z", "z"),
    ("<div>" * 5000 + "deep", "deep"), ("\n \t", ""), ("<p>x y z</p>", "x y z"),
])
def test_odd_markup(markup, text):
    if markup.startswith("<div>" * 10):
        assert wr.text_of(wr.parse(markup), [[]], []) == text
    else:
        assert one(markup) == text


def test_long_pages_take_linear_time():
    for markup in ("<p>" * 100_000, "<" * 200_000, "<p class='" * 20_000, "<!--" * 50_000, "<li>x" * 50_000, "<a " * 50_000):
        wr.parse(markup)


def test_folding_and_optional_parts():
    w = wr.wrapper_of(wr.parse("<div><h2>a</h2><p>b</p><h2>c</h2><p>d</p></div>"))
    assert [(k["g"], k["r"]) for k in w["k"][0]["k"]] == [("h2", True), ("p", True)]
    both = wr.align(wr.wrapper_of(wr.parse("<div><h1>x</h1><p>y</p></div>")), wr.wrapper_of(wr.parse("<div><p>z</p></div>")))
    assert [(k["g"], k["n"]) for k in both["k"][0]["k"]] == [("h1", 1), ("p", 2)]


def test_any_order_gives_the_same_reading():
    pages = [page(i) for i in range(9)]
    ws = [wr.wrapper_of(wr.parse(p)) for p in pages]
    left = ws[0]
    for w in ws[1:]:
        left = wr.align(left, w)
    right = ws[-1]
    for w in reversed(ws[:-1]):
        right = wr.align(w, right)
    assert wr.reading(left) == wr.reading(json.loads(json.dumps(right)))


def test_test_table(spark):
    got = {r.page_id: r for r in QUERIES["op2_main_text"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        inside = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        text = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].url, got[r.page_id].n_chars) == (text, r.url, len(text))


def test_nulls_repeats_clashes_and_a_large_host(spark):
    rows = [(i, f"http://h.org/{i}", page(i), "t") for i in range(200)]
    rows += [(500, "http://h.org/e", None, None), (None, None, plain(1), "t"), (3, "http://h.org/3", page(3), "t"), (501, "x", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(7)
    got = wr.main_text(pages, wr.Rules(fan_in=3)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert all(by[i].text == WANT.format(i=i) for i in range(200)) and by[500].text == "" and by[501].n_chars == 0
    assert sum(r.page_id == 3 for r in got) == 2 and "word1" in by[None].text


def test_empty_table(spark):
    assert wr.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
