"""Benchmark passages in training texts, found through spaced seeds.

A seed looks at five words of a stretch and ignores the rest, as its mask
says; the masks together find every stretch with six equal words or more that
are 70 % of it. Shorter items have masks of their own, down to one word. Words
are runs of letters and digits, lower-cased. A hit fixes how a text and an item
lie to each other; their words are then compared along it and every stretch
that counts is kept, replaced words included.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm import hashing as hx

MASKS = (
    "11111", "111011", "11010011", "101111", "11010101", "1101011", "1100111", "110111", "1110011", "11100101", "11100011",
)
PREFILTER_BITS = 22


@dataclass(frozen=True)
class Overlap:
    """An item is in a text if stretches with at least ``share`` of equal words and ``short`` of them each cover
    ``words`` of its words, or ``part`` of all where it has fewer."""

    words: int = 10
    short: int = 6
    share: float = 0.7
    part: float = 0.8


def _seeds(hashes: np.ndarray, first: np.ndarray, mask: str, no: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the stretches that the mask fits into."""
    at = hx.window_starts(first, len(mask))
    total = np.full(len(at), no + 1, hx.U)
    for place, bit in enumerate(mask):
        if bit == "1":
            total = (total ^ hashes[at + place]) * hx.U(hx.BASES[0])
    return at, hx.mix(total)


def _masks(size: int, how: Overlap) -> tuple[str, ...]:
    """Masks that find every stretch of an item of ``size`` words that counts."""
    need = math.ceil(min(how.short, how.part * size) - 1e-9)
    if need >= 6:
        return MASKS
    span, found = min(size, int(need / how.share + 1e-9)), {"1"} if need <= 1 else set()
    for width in range(max(need, 2), span + 1) if need > 1 else ():
        for inner in itertools.combinations(range(1, width - 1), need - 2):
            found.add("".join("1" if i in (0, width - 1, *inner) else "0" for i in range(width)))
    return tuple(sorted(found))


class _Bank:
    """The seeds of a block of benchmark items, sorted by hash."""

    def __init__(self, item_ids: list, texts: list[str], how: Overlap):
        self.how, self.item_ids = how, item_ids
        words = hx.Words(pa.array(texts, pa.string()), hx.NOT_ALNUM)
        self.hashes, self.first = words.hashes(), words.first
        sizes = np.diff(self.first)
        wanted: dict[str, list[int]] = {m: [] for m in MASKS}
        for size in np.unique(sizes[sizes > 0]).tolist():
            for mask in _masks(size, how):
                wanted.setdefault(mask, []).append(size)
        self.masks, found = list(wanted), []
        for no, (mask, fit) in enumerate(wanted.items()):
            at, seeds = _seeds(self.hashes, self.first, mask, no)
            held = np.isin(sizes[np.searchsorted(self.first, at, side="right") - 1], fit)
            found.append((at[held], seeds[held]))
        at, seeds = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.at = seeds[order], at[order]
        self.item = np.searchsorted(self.first, self.at, side="right") - 1
        self.there = np.zeros(1 << PREFILTER_BITS, bool)
        self.there[(self.seeds >> hx.U(64 - PREFILTER_BITS)).astype(np.int64)] = True

    def diagonals(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct (text, item, word of the batch on which the item's first word lies) of all hits."""
        out = []
        for no, mask in enumerate(self.masks):
            at, seeds = _seeds(hashes, first, mask, no)
            near = np.flatnonzero(self.there[(seeds >> hx.U(64 - PREFILTER_BITS)).astype(np.int64)])
            low = np.searchsorted(self.seeds, seeds[near], side="left")
            number = np.searchsorted(self.seeds, seeds[near], side="right") - low
            hit = hx.ranges(low, number)
            at = np.repeat(at[near], number)
            item = self.item[hit]
            lies = at - (self.at[hit] - self.first[item])
            text = np.searchsorted(first, at, side="right") - 1
            out.append(np.stack([text, item, lies], axis=1))
        return np.unique(np.concatenate(out), axis=0)

    def compare(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text, item, words of the item found, its words, first word in the text, end) of every overlap."""
        best: dict[tuple[int, int], list] = {}
        for text, item, lies in self.diagonals(hashes, first).tolist():
            a, size = self.first[item], self.first[item + 1] - self.first[item]
            low, high = max(0, first[text] - lies), min(size, first[text + 1] - lies)
            same = self.hashes[a + low : a + high] == hashes[lies + low : lies + high]
            held = _covered(same, min(self.how.short, self.how.part * size), self.how.share)
            if len(held):
                seen = best.setdefault((text, item), [set(), lies + low + held[0], 0])
                seen[0].update((low + held).tolist())
                seen[1] = min(seen[1], lies + low + held[0])
                seen[2] = max(seen[2], lies + low + held[-1] + 1)
        for (text, item), (covered, begin, end) in best.items():
            size = int(self.first[item + 1] - self.first[item])
            if len(covered) >= min(self.how.words, self.how.part * size):
                yield text, item, len(covered), size, int(begin - first[text]), int(end - first[text])


def _covered(same: np.ndarray, least: float, share: float) -> np.ndarray:
    """Equal words that lie in any stretch with ``least`` equal words and ``share`` of them."""
    if same.sum() < least:
        return np.empty(0, np.int64)
    equal = np.concatenate([[0], np.cumsum(same)])
    above = equal - share * np.arange(len(equal))
    # the longest stretch from each word on in which the share holds; a shorter one has no more equal words
    most = np.maximum.accumulate(above[::-1])
    begin = np.arange(len(same))
    end = len(same) - np.searchsorted(most, above[:-1] - 1e-9)
    good = (end > begin) & (equal[end] - equal[begin] >= least)
    steps = np.zeros(len(same) + 1, np.int64)
    np.add.at(steps, begin[good], 1)
    np.add.at(steps, end[good], -1)
    return np.flatnonzero(same & (np.cumsum(steps[:-1]) > 0))


def _best_stretch(same: np.ndarray) -> tuple[int, int]:
    """Bounds of the stretch with the largest surplus of equal over unequal words; the first of several."""
    sums = np.concatenate([[0], np.cumsum(np.where(same, 1, -1))])
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - low))
    return int(np.flatnonzero(sums[: end + 1] == low[end])[-1]), end


def _banks(benchmark: DataFrame, how: Overlap, block_bytes: int) -> Iterator[_Bank]:
    """The benchmark in blocks of about ``block_bytes``; only one is on the driver at a time."""
    items = benchmark.select("item_id", F.lower("text").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        if rows:
            yield _Bank([r.item_id for r in rows], [r.text for r in rows], how)


def overlaps(docs: DataFrame, benchmark: DataFrame, how: Overlap = Overlap(), block_bytes: int = 8 << 20) -> DataFrame:
    """One row per text and benchmark item in it: doc_id, item_id, n_matched, n_item_words, from_word, to_word.

    The benchmark goes to the tasks in blocks of bounded size, one pass over
    the texts each (a single pass for up to 8 MiB of benchmark); texts are not
    shuffled. Nulls: null texts and items hold nothing; null and repeated ids
    are reported as they are, one row for each input row and item. Items
    without a word match nothing. Empty tables give no rows. Other columns are
    not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower("text").alias("text"))
    schema = "doc_id long, item_id long, n_matched long, n_item_words long, from_word long, to_word long"
    out = None
    for bank in _banks(benchmark, how, block_bytes):
        found = rows.mapInArrow(_finder(spark.sparkContext.broadcast(bank)), schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def _finder(bank):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hx.slices(batches, "text"):
            words = hx.Words(batch.column("text"), hx.NOT_ALNUM)
            found = list(bank.value.compare(words.hashes(), words.first))
            ids = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
            named = [bank.value.item_ids[f[1]] for f in found]
            yield pa.record_batch(
                [ids, pa.array(named, pa.int64()), *(pa.array([f[i] for f in found], pa.int64()) for i in range(2, 6))],
                names=["doc_id", "item_id", "n_matched", "n_item_words", "from_word", "to_word"],
            )

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, how: Overlap = Overlap(), block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, all columns as they are; null texts stay."""
    spark = docs.sparkSession
    for bank in _banks(benchmark, how, block_bytes):
        docs = docs.filter(_clean(spark.sparkContext.broadcast(bank))(F.coalesce(F.lower("text"), F.lit(""))))
    return docs


def _clean(bank):
    def run(texts: pa.Array) -> pa.Array:
        out = np.ones(len(texts), bool)
        batch = pa.record_batch([texts, pa.array(np.arange(len(texts)))], names=["text", "at"])
        for part in hx.slices(iter([batch]), "text"):
            words = hx.Words(part.column("text"), hx.NOT_ALNUM)
            base = part.column("at")[0].as_py()
            for text, *_ in bank.value.compare(words.hashes(), words.first):
                out[base + text] = False
        return pa.array(out)

    return F.arrow_udf(run, "boolean")
