"""Hosts, paths and rules against plain Python; templates and verdicts on small trees."""

import re

from corpuslab.llm import urlfilter as uf
from corpuslab.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    best = (None, None)
    for act, r in uf.RULES:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(r) > len(best[0] or ""):
            best = (r, act)
    return best


URLS = [
    None, "", "no scheme/x", "http://", "http://A.Example.NET/en/1?x#y", "https://net", "https://net/", "x://y.net#/a",
    "http://b.example.com/de/", "http://b.example.com/de", "http://xexample.com/de/a", "http://é.org/fr/a?b",
    "HTTP://Q.ORG/FR/a", "http://a/b://c/d", "//x.net/a", "http://x.org/fr/é\n/z", "http://www.example.net/en", "a://ÀB.net/",
]


def test_odd_addresses(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(None, None, "h"), (3, URLS[3], "h")],
                                  "page_id long, url string, host string")
    labels = spark.createDataFrame([], "page_id long, good boolean")
    out = uf.judge(pages, labels).collect()
    assert len(out) == len(URLS) + 2
    for r in out:
        host, path = parts(URLS[r.page_id] if r.page_id is not None else None)
        name, act = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == (act or "allow")


def test_test_table(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = QUERIES["op9_url_filters"](spark, SF).collect()
    assert {r.page_id for r in out} == set(pages) and len(out) == len(pages)
    for r in out:
        assert (r.host, r.path) == parts(pages[r.page_id]) and (r.rule, r.verdict)[0] == rule(r.host, r.path)[0]


def test_templates_are_learnt_and_rejected(spark):
    rows = [(i, f"http://s.edu/shop/{i}/buy") for i in range(60)]
    rows += [(100 + i, f"http://s.edu/docs/{i}.html") for i in range(60)]
    rows += [(200 + i, f"http://t.edu/{'en' if i % 2 else 'fr'}/{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    marks = [(i, False) for i in range(40)] + [(100 + i, True) for i in range(40)] + [(200 + i, True) for i in range(9)]
    labels = spark.createDataFrame([*marks, (45, None)], "page_id long, good boolean")
    got = {r.page_id: r for r in uf.judge(pages, labels).collect()}
    assert {got[i].template for i in range(60)} == {"/shop/*/buy"}
    assert all(got[i].verdict == "block" for i in range(60))  # unlabelled ones too
    assert all(got[100 + i].verdict == "allow" and got[100 + i].template == "/docs/*" for i in range(60))
    assert {got[200 + i].template for i in range(60)} == {"/en|fr/*"}


def test_branches_merge_only_while_alike():
    rows = [("a", 100, 0, 90, 10), ("b", 100, 0, 85, 15), ("c", 100, 0, 5, 95), ("d", 3, 3, 1, 0)]
    names = uf.merge_branches(rows, 0.05)
    assert names["a"] == names["b"] != names["c"] and "a" in names["a"].split("|")


def test_sections_of_a_large_host_are_judged_apart(spark):
    for sections in (50, 51, 140):
        at = [(s * 40 + i, s, i) for s in range(sections) for i in range(40)]
        pages = spark.createDataFrame([(p, f"http://s.edu/sec{s}/{i}") for p, s, i in at], "page_id long, url string")
        labels = spark.createDataFrame([(p, s % 3 > 0) for p, s, i in at if i < 30], "page_id long, good boolean")
        got = {r.page_id: r for r in uf.judge(pages, labels).collect()}
        assert all(got[p].verdict == ("allow" if s % 3 else "block") for p, s, _ in at)
        assert len({r.template for r in got.values()}) == 2
        # a label or two for each section do not tell them apart
        few = spark.createDataFrame([(p, s % 3 > 0) for p, s, i in at if i < 1 + s % 2], "page_id long, good boolean")
        got = uf.judge(pages, few).collect()
        assert len({r.template for r in got}) == 1 and all(r.verdict == "allow" for r in got)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge(empty, spark.createDataFrame([], "page_id long, good boolean")).count() == 0
