"""Personal data: identifiers of fixed shape, and more of them found by their contexts.

The four base kinds are regular expressions. Their finds seed a bootstrap over
the whole corpus: the words around an identifier are its patterns, Spark scores
the graph of patterns and values in rounds (a pattern by the share of its
distinct values that are known, a value by its patterns), and patterns that end
with high confidence name the kind of identifier-like tokens that no expression
knows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.llm import hashing as hx
from corpuslab.llm.store import keep
from corpuslab.session import lookup

# The base kinds of the contract, in its order.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"\w+|[^\w\s]")
_EDGES = frozenset(" \t\n\r\x0b\x0c\"'<>()[]{},;=:|`")
# what the bootstrap may name besides tokens with a digit or @: digit groups, and addresses with a written-out at
_MARKS = re.compile(r"[0-9@]+")
_GROUPS = re.compile(r"(?<!\w)[(]?[0-9]++(?:[\x20()./-]{1,3}[0-9]++)++(?!\w)")
_AT = re.compile(r"\x20?@\x20?|[\[({<]\x20?[aA][tT]\x20?[\])}>]\x20?|\x20[aA][tT]\x20")
_DOT = r"(?:\.|\x20?[\[({<]\x20?[dD][oO][tT]\x20?[\])}>]\x20?|\x20[dD][oO][tT]\x20)"
_HOST = re.compile(rf"[\w-]++(?:{_DOT}[\w-]++)*{_DOT}[^\W\d_]{{2,}}+")
SHORTEST, REACH = 6, 48


@dataclass(frozen=True)
class Bootstrap:
    """``rounds`` of scoring; a pattern is taken from ``confidence`` on, with ``support`` known distinct
    values; ``doubt`` counts as that many unknown values of every pattern."""

    rounds: int = 3
    confidence: float = 0.8
    support: float = 5.0
    doubt: float = 1.0


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # from each @ outwards, so that long runs without one cost nothing
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            done = m.end()
            yield start, done
        # what a failed @ leaves behind cannot be part of a later local part
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every base identifier, by start and then in the order of ``KINDS``."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical contexts: one word before, two words before, and the word before with the one after."""
    line = text.rfind("\n", max(0, start - REACH), start) + 1
    before = _TOKEN.findall(text[max(line, start - REACH, 0) : start].lower())
    after = _TOKEN.findall(text[end : end + REACH].split("\n", 1)[0].lower())
    words = [i for i, t in enumerate(before) if t[0].isalnum()]
    out = []
    if words:
        near = " ".join(before[words[-1] :])
        out.append(near + " _")
        if len(words) > 1:
            out.append(" ".join(before[words[-2] :]) + " _")
        if after:
            out.append(near + " _ " + after[0])
    return out


def _marked(text: str) -> Iterator[tuple[int, int]]:
    """Spans of tokens with a digit or an @."""
    done = 0
    for m in _MARKS.finditer(text):
        if m.start() < done:
            continue
        start, end = m.span()
        while start > done and text[start - 1] not in _EDGES:
            start -= 1
        while end < len(text) and text[end] not in _EDGES:
            end += 1
        done = end
        while text[end - 1] in ".!?" and end > start:
            end -= 1
        yield start, end


def _written_out(text: str) -> Iterator[tuple[int, int]]:
    """Spans of a name, an at sign or word, and a host with signs or words for its dots."""
    done, m = 0, _AT.search(text)
    while m:
        stop = m.start()
        if stop > done and text[stop - 1] == " ":
            stop -= 1
        start = stop
        while start > done and text[start - 1] not in _EDGES:
            start -= 1
        host = _HOST.match(text, m.end()) if start < stop else None
        done = m.end()
        if host:
            done = host.end()
            yield start, done
        # the blank behind one at may stand before the next
        m = _AT.search(text, done - 1 if text[done - 1] == " " and done - 1 > m.start() else done)


def _other_tokens(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Spans of every shape that identifiers have and that no base identifier touches: tokens with a digit or an @,
    runs of digit groups, and written-out addresses; of those with the same start the longest."""
    longest: dict[int, int] = {}
    for start, end in (*_marked(text), *(m.span() for m in _GROUPS.finditer(text)), *_written_out(text)):
        longest[start] = max(end, longest.get(start, 0))
    i, spans = 0, sorted((a, b) for _, a, b in taken)
    for start, end in sorted(longest.items()):
        while i < len(spans) and spans[i][1] <= start:
            i += 1
        if SHORTEST <= end - start and not (i < len(spans) and spans[i][0] < end):
            yield start, end


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_MENTION = pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.int64()),
    ("patterns", pa.list_(pa.string())),
])
FOUND = (
    "spans array<struct<kind:string,start:long,end:long>>, base_sha256 string, "
    "mentions array<struct<kind:string,start:long,end:long,value:long,patterns:array<string>>>"
)


def _value(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in hx.slices(batches, "__text"):
        spans, digests, mentions = [], [], []
        for text in batch.column("__text").to_pylist():
            text = text or ""
            base = base_spans(text)
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
            digests.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest())
            mentions.append([
                {"kind": k, "start": a, "end": b, "value": _value(text[a:b]), "patterns": _patterns(text, a, b)}
                for k, a, b in [*base, *((None, a, b) for a, b in _other_tokens(text, base))]
            ])
        carried = [batch.column(n) for n in batch.schema.names if n != "__text"]
        names = [n for n in batch.schema.names if n != "__text"]
        yield pa.record_batch(
            [*carried, pa.array(spans, pa.list_(_SPAN)), pa.array(digests, pa.string()),
             pa.array(mentions, pa.list_(_MENTION))],
            names=[*names, "spans", "base_sha256", "mentions"],
        )


def scan(rows: DataFrame) -> DataFrame:
    """Base spans, their digest and all mentions with their contexts of (row_no, text) rows, beside row_no."""
    return keep(
        rows.select("row_no", F.col("text").alias("__text")).mapInArrow(_scan, f"row_no long, {FOUND}"), "mentions"
    )


def learn_patterns(mentions: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """(pattern, kind, confidence) of the patterns to trust.

    ``mentions`` has pattern, value, kind (null: unknown). Values count once for
    a pattern however often they occur, so a line copied a million times proves
    nothing.
    """
    known = [F.max((F.col("kind") == k).cast("double")).alias(f"s_{k}") for k in KINDS]
    edges = mentions.groupBy("pattern", "value").agg(*[F.coalesce(c, F.lit(0.0)).alias(f"s_{k}")
                                                       for c, k in zip(known, KINDS, strict=True)])
    # a pattern with fewer values than the support can never be taken
    counts = edges.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= how.support)
    edges = keep(edges.join(counts, "pattern"), "edges")
    scores = edges
    for round_no in range(how.rounds):
        patterns = scores.groupBy("pattern").agg(
            F.first("n").alias("n"), *[F.sum(f"s_{k}").alias(f"t_{k}") for k in KINDS]
        ).select("pattern", "n", *[
            F.struct((F.col(f"t_{k}") / (F.col("n") + how.doubt)).alias("c"), F.col(f"t_{k}").alias("t")).alias(f"p_{k}")
            for k in KINDS
        ])
        if round_no == how.rounds - 1:
            break
        # a value is known as far as one of its patterns is right (noisy or)
        doubt = [
            F.sum(F.log(F.lit(1.0) - F.when(F.col(f"p_{k}.c") >= how.confidence, F.col(f"p_{k}.c")).otherwise(0.0)))
            .alias(f"d_{k}") for k in KINDS
        ]
        values = edges.select("pattern", "value").join(patterns, "pattern").groupBy("value").agg(*doubt)
        scores = edges.join(values, "value").select(
            "pattern", "value", "n",
            *[F.greatest(F.col(f"s_{k}"), F.lit(1.0) - F.exp(f"d_{k}")).alias(f"s_{k}") for k in KINDS],
        )
    best = F.array_max(F.array(*[
        F.struct(F.col(f"p_{k}.c").alias("c"), F.col(f"p_{k}.t").alias("t"), F.lit(k).alias("k")) for k in KINDS
    ]))
    return patterns.select("pattern", best.alias("b")).filter(
        (F.col("b.c") >= how.confidence) & (F.col("b.t") >= how.support)
    ).select("pattern", F.col("b.k").alias("kind"), F.col("b.c").alias("confidence"))


def discover(found: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """(row_no, added): per row of ``scan`` the spans that trusted patterns name, where there are any."""
    each = found.select("row_no", F.explode("mentions").alias("m")).select(
        "row_no", "m.kind", "m.start", "m.end", "m.value", F.explode("m.patterns").alias("pattern")
    )
    trusted = lookup(learn_patterns(each.select("pattern", "value", "kind"), how))
    named = each.filter("kind is null").drop("kind").join(trusted, "pattern").groupBy("row_no", "start", "end").agg(
        F.max(F.struct("confidence", "kind")).alias("best")
    )
    return named.groupBy("row_no").agg(
        F.collect_list(F.struct(F.col("best.kind").alias("kind"), "start", "end")).alias("added")
    )


def _listed(spans: Column) -> Column:
    order = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(F.lit(list(KINDS)), s["kind"]).alias("o"),
            s["end"].alias("end"), s["kind"].alias("kind"),
        ),
    )
    return F.transform(
        F.sort_array(order), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def find(docs: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """doc_id, one count for each base kind, base_sha256, and all spans, one row per input row.

    A null text is empty and has no span; null and repeated doc_ids are kept
    apart by row; other columns are not read; an empty table gives no rows.
    Spans are half-open ranges of code points. Added spans never touch base
    ones.
    """
    # numbers are fixed by writing them beside the finds of the same task
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("__text"))
    found = keep(
        ids.mapInArrow(_scan, f"doc_id long, {FOUND}").withColumn("row_no", F.monotonically_increasing_id()), "mentions"
    )
    added = discover(found, how)
    kinds = F.col("spans.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return found.join(added, "row_no", "left").select(
        "doc_id", *counts, "base_sha256",
        _listed(F.concat("spans", F.coalesce("added", none))).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; spans that overlap become one."""
    out, done = [], 0
    joined: list[list] = []
    for kind, a, b in spans:
        if joined and a < joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], b)
        else:
            joined.append([kind, a, b])
    for kind, a, b in joined:
        out += [text[done:a], f"<{kind.upper()}>"]
        done = b
    return "".join([*out, text[done:]])


def _masked(texts: pd.Series, added: pd.Series) -> pd.Series:
    out = []
    for text, more in zip(texts, added, strict=True):
        if text:
            spans = base_spans(text)
            for span in more.split(",") if more else ():
                kind, a, b = span.split(":")
                spans.append((kind, int(a), int(b)))
            text = mask_text(text, sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))) if spans else text
        out.append(text)
    return pd.Series(out, dtype="object")


def mask(docs: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, and ``n_chars``, if there, counted anew.

    Rows, other columns and nulls stay as they are. Texts are written once with
    a row number, so that finds and texts meet again.
    """
    tagged = keep(docs.withColumn("__row_no", F.monotonically_increasing_id()), "tagged")
    found = scan(tagged.select(F.col("__row_no").alias("row_no"), "text"))
    added = lookup(discover(found, how).select(F.col("row_no").alias("__row_no"), span_text(F.col("added")).alias("__added")))
    done = tagged.join(added, "__row_no", "left").withColumn("text", F.pandas_udf(_masked, "string")("text", F.coalesce("__added", F.lit(""))))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])
