"""Base identifiers against the expressions as written, and the bootstrap on small corpora."""

import hashlib
import random
import re

from hypothesis import example, given, settings
from hypothesis import strategies as st

from corpuslab.llm import pii

SF = "/root/testdata/sf0.001"


def luhn(digits):
    numbers = [int(c) for c in digits[::-1]]
    return sum(numbers[::2] + [sum(divmod(2 * n, 10)) for n in numbers[1::2]]) % 10 == 0


def plain(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


PARTS = st.sampled_from([
    "a", "z.q", "@", "@b.co", ".", "-", "+", "%", " ", "\n", "1", "25", "255", "256", "0", "4539578763621486",
    "4539 5787 6362 1486", "+1 (212) 555-0199", "(", ")", "é", "_", "1.2.3.4", "..", "000",
])


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
@example("x@y.com_z@w.org a@@b.com a@b@c.com 1.2.3.4.5.6.7.8 0001.2.3.4 300.1.1.1.1")
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "@a" * 100_000, "1." * 100_000, "+1 (" * 50_000, "a.@" * 100_000):
        pii.base_spans(text)
        list(pii._other_tokens(text, []))


def test_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    total = 0
    for r in docs.collect():
        spans = plain(r.text)
        total += len(spans)
        g = got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert set(spans) <= {tuple(s) for s in g.spans}
    assert total > 20 and len(got) == docs.count()


def corpus():
    rng = random.Random(1)
    rows = [f"Then call me at +1 (212) 555-{1000 + i} soon" for i in range(30)]
    rows += ["We said: call me at 5550199-22 soon", "code 99123-77 is no number to ring"]
    rows += [f"item {rng.randrange(10**6)}x of a list" for _ in range(30)]
    return rows


def test_bootstrap_finds_what_no_expression_knows(spark):
    rows = corpus()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(docs).collect()}
    a = rows[30].index("5550199")
    assert got[30] == [("phone", a, a + len("5550199-22"))]
    assert all(got[i] == [] for i in range(31, len(rows))) and all(len(got[i]) == 1 for i in range(30))


def test_bootstrap_names_every_shape(spark):
    rng = random.Random(2)
    rows = [f"Then call me at +1 (212) 555-{1000 + i} soon" for i in range(30)]
    rows += [f"mail goes to user{i}@host.org today" for i in range(30)]
    cards = [n for n in (str(rng.randrange(10**15, 10**16)) for _ in range(600)) if luhn(n)][:30]
    rows += [f"the account number {c} was used" for c in cards]
    hidden = [("phone", "call me at {} soon", x) for x in ("0176 555 123", "(030) 123 4567", "5550199-22")]
    hidden += [("email", "mail goes to {} today", x) for x in (
        "hans@exämple.de", "jane[at]host.org", "jane (at) host (dot) org", "jane at host dot org", "jane@host [dot] org",
        "x" * 90 + "@exämple.de")]
    hidden += [("card", "the account number {} was used", x) for x in ("1234 5678 9012 3456", "1" * 85)]
    plain_rows = ["we met at home and dot the line", "he looked at it 3 times"]
    first = len(rows)
    texts = rows + [t.format(x) for _, t, x in hidden] + plain_rows
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(docs).collect()}
    for i, (kind, t, x) in enumerate(hidden, first):
        assert got[i] == [(kind, t.index("{}"), t.index("{}") + len(x))], texts[i]
    assert got[len(texts) - 1] == got[len(texts) - 2] == []


def test_long_candidates_take_linear_time():
    for text in ("jane at " * 40_000, "1 (" * 100_000, "a[at]" * 60_000, "@a.b " * 60_000, "x@" + "a." * 100_000, " at " * 80_000):
        list(pii._other_tokens(text, []))


def test_one_value_copied_often_proves_nothing(spark):
    rows = ["call me at +1 (212) 555-1000 soon"] * 50 + ["call me at 5550199-22 soon"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert [r.spans for r in pii.find(docs).collect() if r.doc_id == 50] == [[]]


def test_mask(spark):
    rows = [(i, t, 9, "k") for i, t in enumerate([*corpus(), None, "", "née a@b.co 😀 10.0.0.1"])] + [(None, "x 1.2.3.4", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, added string").repartition(2)
    out = pii.mask(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    got = {r.doc_id: r for r in out.collect()}
    assert got[30].text == "We said: call me at <PHONE> soon" and got[0].text == "Then call me at <PHONE> soon"
    assert got[62].text is None and got[62].n_chars is None and got[63].text == ""
    assert got[64].text == "née <EMAIL> 😀 <IP>" and got[64].n_chars == len(got[64].text)
    assert got[None].text == "x <IP>"


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(empty).count() == 0 and pii.mask(empty).count() == 0
