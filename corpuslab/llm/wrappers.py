"""Main text of web pages through wrappers inferred from the pages of a host.

A page becomes a tree of blocks whose nodes are named by tag, class and id.
A wrapper is a union-free regular expression over such trees: sequences,
optional parts, repeated parts and text slots. It is inferred by aligning
trees: runs of equal siblings fold into one repeated part, siblings that only
one side has become optional, and text that differs becomes a slot. Wrappers
align with each other just like pages do, so that the pages of a host are
folded in any order: within a batch first, then in rounds of bounded fan-in,
and no host, however large, meets in one task.

A host's wrapper says which part holds the article and which parts are not
text of it: menus, headers, footers, adverts and the like by name, parts that
are mostly links, and parts that read the same on all pages.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm import hashing as hx
from corpuslab.llm.store import keep
from corpuslab.llm.urlfilter import host_of
from corpuslab.session import lookup

# Elements by their role in HTML.
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "caption legend".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math title head select object canvas video audio".split())
DROPPED = frozenset("nav footer aside form menu dialog button label fieldset".split())
CLOSES_P = BLOCKS - {"html", "body", "caption", "legend", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}}
# Words in class, id or role that name parts beside the article.
BESIDE = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner topbar footer contentinfo sidebar "
    "side aside complementary ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo "
    "promotion promoted cookie cookies consent gdpr notice notices notification alert warning popup modal overlay dialog "
    "newsletter subscribe subscription signup login signin register search searchform form share sharing shares social "
    "related recommended recommendations recommendation trending popular comments comment commentlist discussion disqus "
    "replies reply respond feedback pagination pager paging toolbar widget widgets tags tagcloud legal copyright "
    "disclaimer skip skiplink toc outbrain taboola hidden visuallyhidden sr".split()
)
# Words in class, id, role or itemprop that name the article.
ARTICLE = frozenset("article articlebody post entry story maincontent postcontent entrycontent articlecontent".split())

_TAG_END = re.compile(r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"""(class|id|role|itemprop|hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_LONGEST_TAG = 20_000


@dataclass
class Node:
    tag: str
    name: str
    beside: bool
    block: bool
    main: bool = False
    kids: list = field(default_factory=list)  # nodes, or (text, inside a link)


def _node(tag: str, attributes: str) -> Node:
    beside, main, label = tag in DROPPED, tag in ("article", "main"), []
    for key, *values in _ATTR.findall(attributes) if attributes else ():
        key, value = key.lower(), next((v for v in values if v), "")
        if key == "hidden" or key == "style":
            if key == "hidden" or "display:none" in value.replace(" ", "").lower():
                beside = True
                label.append("hidden")
        else:
            parts = [p.lower() for p in _PARTS.findall(value)]
            # on the page as a whole such words say nothing
            if tag not in ("html", "body", "main", "article") or "comment" in parts or "comments" in parts:
                beside |= not BESIDE.isdisjoint(parts)
            main |= key in ("role", "itemprop") and value.lower() in ("main", "article", "articlebody")
            main |= not ARTICLE.isdisjoint(["".join(parts), *parts]) and tag in ("div", "section", "td")
            if key != "itemprop":
                label.append(re.sub(r"[0-9]+", "0", value.strip().lower())[:60])
    return Node(tag, ".".join([tag, *label]), beside, tag in BLOCKS, main and not beside)


def parse(page: str) -> Node:
    """The tree of blocks of a page; inline elements leave only their text. Never fails, whatever the markup."""
    root = Node("", "", False, True)
    stack, links, at, end = [root], 0, 0, len(page)

    def close(names: set[str], scope: set[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while at < end:
        less = page.find("<", at)
        if less != at:
            text = page[at : less if less >= 0 else end]
            stack[-1].kids.append((entities.unescape(text), links > 0))
            if less < 0:
                break
            at = less
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            at = stop + 3 if stop >= 0 else end
            continue
        closing = page.startswith("</", at)
        name = _NAME.match(page, at + 1 + closing)
        if not name:
            if page[at + 1 : at + 2] in ("!", "?") or closing:
                stop = page.find(">", at)
                at = stop + 1 if stop >= 0 else end
            else:
                stack[-1].kids.append(("<", links > 0))
                at += 1
            continue
        tag = name[0].lower()
        stop = _TAG_END.match(page, name.end(), name.end() + _LONGEST_TAG)
        after = stop.end() if stop else page.find(">", name.end()) + 1 or end
        attributes = page[name.end() : after - 1]
        at = after
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            elif any(n.tag == tag for n in stack):
                close({tag})
            elif tag == "p":
                stack[-1].kids.append(Node("p", "p", False, True))
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                shut = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
                if shut:
                    at = page.find(">", shut.end()) + 1 or end
                elif tag in ("script", "style", "textarea", "title"):
                    at = end
            continue
        if tag in VOID:
            stack[-1].kids.append((" ", links > 0) if tag != "hr" else Node("hr", "hr", False, True))
            continue
        if tag == "a":
            links += 1
            continue
        if tag in CLOSES_P:
            close({"p"}, {"li", "td", "th", "dd", "div", "section", "article", "blockquote", "body"})
        if tag in SAME:
            close(SAME[tag], SCOPES[tag])
        if tag in BLOCKS or attributes:
            node = _node(tag, attributes)
            if node.block or node.beside:
                links = 0 if node.block and tag != "li" else links
                stack[-1].kids.append(node)
                stack.append(node)
    return root


def _squeezed(text: str) -> str:
    return " ".join(text.split())


# A wrapper node is a dict: g name, t tag, b beside, m names the article, r repeated, n pages, z characters of its own
# text, y of them in links, c digest of its text ("" where pages differ), k parts in order.


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=6).hexdigest()


def wrapper_of(node: Node) -> dict:
    """The wrapper of a single page."""
    own = _squeezed("".join(k[0] for k in node.kids if isinstance(k, tuple)))
    linked = _squeezed("".join(k[0] for k in node.kids if isinstance(k, tuple) and k[1]))
    return {
        "g": node.name, "t": node.tag, "b": node.beside, "m": node.main, "r": False, "n": 1, "z": len(own), "y": len(linked),
        "c": _digest(own) if own else "-", "k": _fold([wrapper_of(k) for k in node.kids if isinstance(k, Node)]),
    }


def _fold(parts: list[dict]) -> list[dict]:
    """Runs of equal siblings, or of equal stretches of up to four, become one repeated part each."""
    for size in (1, 2, 3, 4):
        out: list[dict] = []
        for part in parts:
            out.append(part)
            tail = [p["g"] for p in out[-2 * size :]]
            if len(tail) == 2 * size and tail[:size] == tail[size:]:
                again = out[-size:]
                del out[-size:]
                for i, p in enumerate(again):
                    out[i - size] = _join(out[i - size], p, same_page=True)
        parts = out
    return parts


def _join(a: dict, b: dict, same_page: bool = False) -> dict:
    """The wrapper that fits what ``a`` and ``b`` fit. Equal names only."""
    return {
        "g": a["g"], "t": a["t"], "b": a["b"], "m": a["m"], "r": same_page or a["r"] or b["r"],
        "n": max(a["n"], b["n"]) if same_page else a["n"] + b["n"], "z": a["z"] + b["z"], "y": a["y"] + b["y"],
        "c": a["c"] if a["c"] == b["c"] else "", "k": _align(a["k"], b["k"], same_page),
    }


def _align(a: list[dict], b: list[dict], same_page: bool) -> list[dict]:
    if [x["g"] for x in a] == [x["g"] for x in b]:
        return [_join(x, y, same_page) for x, y in zip(a, b, strict=True)]
    out, i, j = [], 0, 0
    for m in SequenceMatcher(None, [x["g"] for x in a], [x["g"] for x in b], autojunk=False).get_matching_blocks():
        out += a[i : m.a] + b[j : m.b]  # parts of one side are optional: they have fewer pages than their parent
        out += [_join(x, y, same_page) for x, y in zip(a[m.a : m.a + m.size], b[m.b : m.b + m.size], strict=True)]
        i, j = m.a + m.size, m.b + m.size
    return _settled(out)


def _settled(parts: list[dict]) -> list[dict]:
    """Neighbours with equal names, as alignment can leave them, become one repeated part."""
    out: list[dict] = []
    for part in parts:
        if out and out[-1]["g"] == part["g"]:
            out[-1] = {**_join(out[-1], part), "r": True}
        else:
            out.append(part)
    return out


def align(a: dict, b: dict) -> dict:
    return _join(a, b)


@dataclass(frozen=True)
class Rules:
    """A part outside the article that is no text: over ``links`` of its characters are links; or it reads the same on
    ``same_pages`` pages or more. A part is the article by mass if it holds ``mass`` of the text."""

    links: float = 0.5
    same_pages: int = 10
    mass: float = 0.6
    fan_in: int = 32


def reading(wrapper: dict, rules: Rules = Rules()) -> tuple[list[list[str]], list[list[str]]]:
    """(paths of the article, paths to leave out) of a wrapper; a path is the names from the root down."""
    out: list[list[str]] = []
    named: list[tuple[int, list[str], dict]] = []

    def walk(node: dict, path: list[str], inside: bool) -> tuple[int, int]:
        if node["b"] or node["t"] == "header" and not (inside and _has(node, "h1")):
            out.append(path)
            return 0, 0
        chars, linked = node["z"], node["y"]
        if not inside and node["c"] not in ("", "-") and not node["r"] and node["n"] >= rules.same_pages:
            chars = linked = 0
            if not node["k"]:
                out.append(path)
        here = len(out)
        for kid in node["k"]:
            c, y = walk(kid, [*path, kid["g"]], inside or node["m"])
            chars, linked = chars + c, linked + y
        if not inside and not node["m"] and path and chars and linked > rules.links * chars:
            del out[here:]
            out.append(path)
            return 0, 0
        if node["m"]:
            named.append((chars, path, node))
        sizes[tuple(path)] = chars
        return chars, linked

    sizes: dict[tuple, int] = {}
    total, _ = walk(wrapper, [], False)
    if not total:
        return [[]], out
    best = [x for x in named if x[0] > 0]
    if best:
        # the innermost part that holds most of what the largest one holds
        most = max(b[0] for b in best)
        chosen = max((b for b in best if b[0] >= rules.mass * most), key=lambda b: (len(b[1]), b[0]))
        return [chosen[1]], out
    path, node = [], wrapper
    while True:
        kids = [k for k in node["k"] if k["t"] not in ("p", "ul", "ol", "table", "blockquote", "pre") and not k["r"]]
        kid = max(kids, key=lambda k: sizes.get((*path, k["g"]), 0), default=None)
        if kid is None or sizes.get((*path, kid["g"]), 0) < max(1, rules.mass * sizes[tuple(path)]):
            return [path], out
        path, node = [*path, kid["g"]], kid


def _has(node: dict, tag: str) -> bool:
    return any(k["t"] == tag or _has(k, tag) for k in node["k"])


def text_of(root: Node, article: list[list[str]], out: list[list[str]]) -> str:
    """The text blocks of a page inside the paths ``article`` and outside the paths ``out``, one a line."""
    wanted, unwanted = {tuple(p) for p in article}, {tuple(p) for p in out}
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _squeezed("".join(line))
        line.clear()
        if text:
            blocks.append(text)

    # (node, path, inside) or a mark that a block ends; an explicit stack, as markup nests to any depth
    todo: list = [(root, (), () in wanted)]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
            continue
        if isinstance(item[0], str):
            line.append(item[0])
            continue
        node, path, inside = item
        if path in unwanted:
            continue
        if node.block:
            flush()
            todo.append(None)
        for kid in reversed(node.kids):
            if isinstance(kid, Node):
                below = (*path, kid.name)
                todo.append((kid, below, inside or below in wanted))
            elif inside:
                todo.append(kid)
    flush()
    return "\n".join(blocks)


_WRAPPER = "host string, wrapper string"


def _inferred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in hx.slices(batches, "html"):
        found: dict[str, dict] = {}
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            w = wrapper_of(parse(page or ""))
            found[host] = align(found[host], w) if host in found else w
        yield pa.record_batch(
            [pa.array(list(found), pa.string()), pa.array([json.dumps(w) for w in found.values()], pa.string())],
            names=["host", "wrapper"],
        )


def _united(frame: pd.DataFrame) -> pd.DataFrame:
    parts = [json.loads(w) for w in frame["wrapper"].sort_values()]
    w = parts[0]
    for p in parts[1:]:
        w = align(w, p)
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [json.dumps(w)]})


def infer(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(host, wrapper) from (host, html) rows; at most about ``fan_in`` wrappers meet in a task."""
    parts = keep(pages.select("host", "html").mapInArrow(_inferred, _WRAPPER), "wrappers")
    while True:
        counts = parts.groupBy("host").agg(F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return parts
        lots = F.ceil(F.col("n") / rules.fan_in).cast("long")
        numbered = parts.withColumn("no", F.monotonically_increasing_id())
        dealt = numbered.join(lookup(counts), "host").withColumn("lot", F.pmod("no", lots))
        single = dealt.filter("n = 1").select("host", "wrapper")
        parts = keep(
            dealt.filter("n > 1").groupBy("host", "lot").applyInPandas(_united, _WRAPPER).unionByName(single), "wrappers"
        )


def _texts(rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in hx.slices(batches, "html"):
            texts = []
            for page, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                tree = parse(page or "")
                if wrapper not in known:
                    if len(known) >= 1_000:
                        known.clear()
                    known[wrapper] = reading(json.loads(wrapper), rules)
                text = text_of(tree, *known[wrapper])
                if not text:  # a page built unlike the rest of its host is read on its own
                    text = text_of(tree, *reading(wrapper_of(tree), rules))
                texts.append(text)
            yield pa.record_batch({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
            })

    return run


def main_text(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points).

    Nulls: a null page is empty and has the empty text, a null address belongs
    to the host with no name, null page_ids are kept. Repeated rows give equal
    rows. Texts are whole. Other columns are not read; an empty table gives no
    rows.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    wrappers = lookup(infer(rows, rules))
    done = rows.join(wrappers, "host").select("page_id", "url", "html", "wrapper").mapInArrow(
        _texts(rules), "page_id long, url string, text string"
    )
    return done.withColumn("n_chars", F.length("text").cast("bigint"))
