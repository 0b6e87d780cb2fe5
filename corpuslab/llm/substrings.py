"""Removal of word passages that an earlier document holds.

Every window of ``WINDOW`` consecutive words has a Rabin-Karp hash. A window
goes when the same words start in a document with a smaller id, and the
windows that go merge into maximal intervals.

What moves: a window can only be found twice if the least hash among its
10-word stretches (its anchor) is found twice. Anchors change about every
twentieth word, so the first count is over a twentieth of the words; only
windows with an anchor that stands in two different texts are counted by their
own hash. The filter is exact: equal windows have equal anchors. Copies of a
whole text are told by their digest and never expanded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm import hashing as hx
from corpuslab.llm.store import keep
from corpuslab.session import lookup

WINDOW = 50
STRETCH = 10


def _anchors(words: hx.Words, window: int, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, anchor) of every window: the least hash of the stretches in it."""
    at = hx.window_starts(words.first, window)
    if not len(at):
        return at, np.zeros(0, hx.U)
    n = len(words.starts) - stretch + 1
    every = np.arange(n)
    grams = hx.mix(hx.stretches(words.hashes(), every, every + stretch, hx.BASES[1]))
    return at, hx.sliding_min(grams, window - stretch + 1)[at]


def _joined(words: hx.Words, kept: np.ndarray | None = None) -> list[str]:
    """SHA-256 of each text's (kept) words joined by one space."""
    starts, ends = words.starts, words.ends
    bounds = words.first
    if kept is not None:
        bounds = np.concatenate([[0], np.cumsum(kept)])[words.first]
        starts, ends = starts[kept], ends[kept]
    lengths = ends - starts + 1
    taken = words.data[np.minimum(hx.ranges(starts, lengths), max(0, len(words.data) - 1))]
    stops = np.cumsum(lengths)
    taken[stops - 1] = 0x20
    raw, stops = memoryview(taken.tobytes()), np.concatenate([[0], stops])
    return [
        hashlib.sha256(raw[stops[a] : max(stops[a], stops[b] - 1)]).hexdigest()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]


def _outline(window: int, stretch: int):
    """Per text: digest, words, digest of the joined words, distinct anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hx.slices(batches, "text"):
            words = hx.Words(batch.column("text"))
            at, anchor = _anchors(words, window, stretch)
            text = np.searchsorted(words.first, at, side="right") - 1
            order = np.lexsort((anchor, text))
            text, anchor = text[order], anchor[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
            per_text = np.bincount(text[new], minlength=batch.num_rows)
            digests = [hashlib.sha256((x or "").encode()).digest()[:16] for x in batch.column("text").to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "digest": pa.array(digests, pa.binary()),
                "n_words": pa.array(words.counts.astype(np.int64)),
                "joined": pa.array(_joined(words)),
                "anchors": hx.list_array(hx.signed(anchor[new]), per_text, pa.int64()),
            })

    return run


def _window_rows(window: int, stretch: int):
    """The windows of each text whose anchor is in its list ``shared``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hx.slices(batches, "text"):
            words = hx.Words(batch.column("text"))
            at, anchor = _anchors(words, window, stretch)
            text = np.searchsorted(words.first, at, side="right") - 1
            lists = batch.column("shared")
            listed = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths().fill_null(0)))
            shared = np.asarray(lists.flatten()).view(hx.U)
            # one number for (text, anchor); equal numbers of unequal pairs only add windows to count
            salt = hx.mix(np.arange(batch.num_rows).astype(hx.U) + hx.U(1))
            hit = np.flatnonzero(np.isin(anchor ^ salt[text], shared ^ salt[listed]))
            at, text = at[hit], text[hit]
            hashes = words.hashes(), words.hashes(1)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(text)),
                "digest": batch.column("digest").take(pa.array(text)),
                "h1": pa.array(hx.signed(hx.mix(hx.stretches(hashes[0], at, at + window, hx.BASES[0])))),
                "h2": pa.array(hx.signed(hx.mix(hx.stretches(hashes[1], at, at + window, hx.BASES[1])))),
                "start": pa.array((at - words.first[text]).astype(np.int32)),
            })

    return run


def _cut(window: int):
    """Words left of each text when the windows at ``starts`` go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hx.slices(batches, "text"):
            words = hx.Words(batch.column("text"))
            lists = batch.column("starts")
            of = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
            at = np.asarray(lists.flatten()).astype(np.int64) + words.first[of]
            steps = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(steps, at, 1)
            np.add.at(steps, at + window, -1)
            gone = np.cumsum(steps)[:-1] > 0
            edge = np.diff(np.concatenate([[0], gone, [0]]))  # windows of one text never touch the next
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            begin, end = _split_at_texts(begin, end, words.first)
            text = np.searchsorted(words.first, begin, side="right") - 1
            per_text = np.bincount(text, minlength=batch.num_rows)
            removed = np.concatenate([[0], np.cumsum(gone)])[words.first]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "digest": batch.column("digest"),
                "n_removed": pa.array(np.diff(removed).astype(np.int64)),
                "kept_sha256": pa.array(_joined(words, ~gone)),
                "from_word": hx.list_array(begin - words.first[text], per_text, pa.int64()),
                "to_word": hx.list_array(end - words.first[text], per_text, pa.int64()),
            })

    return run


def _split_at_texts(begin: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals cut where one text ends and the next begins."""
    inner = np.unique(first[1:-1])
    owner = np.searchsorted(begin, inner, side="right") - 1
    ok = (owner >= 0) & (len(begin) > 0)
    inner, owner = inner[ok], owner[ok]
    inner = inner[(inner > begin[owner]) & (inner < end[owner])] if len(begin) else inner[:0]
    return np.sort(np.concatenate([begin, inner])), np.sort(np.concatenate([end, inner]))


def repeated_passages(docs: DataFrame, window: int = WINDOW, stretch: int = STRETCH) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, intervals.

    ``intervals`` holds the maximal removed word ranges, from (inclusive) to
    (exclusive). Nulls: a null text has no words; a row with a null doc_id
    keeps all its words and removes none elsewhere, because it is neither
    smaller nor larger. Rows with one doc_id never remove each other's words.
    Texts under ``window`` words keep all. Extra columns are not read. An empty
    table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    outline = keep(
        texts.mapInArrow(
            _outline(window, stretch),
            "doc_id long, digest binary, n_words long, joined string, anchors array<long>",
        ),
        "outline",
    )
    usable = outline.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    classes = usable.groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    ).filter("first_id < last_id").select("digest", "first_id")
    marked = usable.join(classes, "digest", "left")
    leaders = marked.filter("first_id is null or first_id = doc_id")
    each = leaders.select("doc_id", "digest", F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    ).filter("low < high").select("anchor")
    suspects = each.join(shared, "anchor").groupBy("doc_id", "digest").agg(F.collect_list("anchor").alias("shared"))
    held = keep(
        texts.join(lookup(suspects), "doc_id")
        .filter(F.substring(F.unhex(F.sha2("text", 256)), 1, 16) == F.col("digest"))
        .select("doc_id", "digest", "text", "shared"),
        "suspects",
    )
    rows = keep(
        held.mapInArrow(_window_rows(window, stretch), "doc_id long, digest binary, h1 long, h2 long, start int"),
        "windows",
    )
    first = rows.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    ).filter("low < high").select("h1", "h2", "low")
    gone = rows.join(first, ["h1", "h2"]).filter("doc_id > low").groupBy("doc_id", "digest").agg(
        F.collect_set("start").alias("starts")
    )
    cut = held.dropDuplicates(["doc_id", "digest"]).join(gone, ["doc_id", "digest"]).select(
        "doc_id", "digest", "text", "starts"
    ).mapInArrow(
        _cut(window),
        "doc_id long, digest binary, n_removed long, kept_sha256 string, from_word array<long>, to_word array<long>",
    )
    whole = marked.filter("first_id < doc_id").select(
        "doc_id", "digest", F.col("n_words").alias("n_removed"), F.sha2(F.lit(""), 256).alias("kept_sha256"),
        F.array(F.lit(0).cast("bigint")).alias("from_word"), F.array("n_words").alias("to_word"),
    ).dropDuplicates(["doc_id", "digest"])
    changed = cut.unionByName(whole)
    empty = F.array().cast("array<bigint>")
    return outline.select("doc_id", "digest", "n_words", "joined").join(
        changed, ["doc_id", "digest"], "left"
    ).select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("kept_sha256", "joined").alias("kept_sha256"),
        F.arrays_zip(
            F.coalesce("from_word", empty).alias("from_word"), F.coalesce("to_word", empty).alias("to_word")
        ).alias("intervals"),
    )
