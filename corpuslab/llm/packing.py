"""Packing of documents into sequences of fixed length, with a certificate.

Documents are dealt into partitions and each runs best-fit decreasing. Dual
feasible functions give a lower bound on the sequences that a partition's
lengths need. Where the count meets the bound only the emptiest sequence is
opened again, elsewhere every sequence with room; their documents are dealt
anew with those of other partitions and packed again, until one partition
holds what is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm import hashing as hx
from corpuslab.llm.encode import WordEncoder
from corpuslab.llm.store import keep

CAPACITY = 2048
PARTITION_ROWS = 50_000
ROUNDS = 8

SLICE_BYTES = 4 << 20  # of text that a worker encodes at once: fewer take more time, as equal words of a slice meet once

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(tokenizer: str, end_id: int, capacity: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        for batch in hx.slices(batches, "text", slice_bytes):
            ids, bounds = encoder.with_end(batch.column("text"), end_id)
            lengths = np.diff(bounds)
            parts = -(-lengths // capacity)
            doc = np.repeat(np.arange(batch.num_rows), parts)
            piece = hx.ranges(np.zeros(len(parts), np.int64), parts)
            start = piece * capacity
            size = np.minimum(capacity, lengths[doc] - start)
            raw, first = memoryview(ids.astype("<u4").tobytes()), (bounds[doc] + start) * 4
            crc = [zlib.crc32(raw[a : a + n * 4]) for a, n in zip(first.tolist(), size.tolist(), strict=True)]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(doc)),
                "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start), "length": pa.array(size),
                "ids_crc32": pa.array(crc, pa.int64()),
            })
        # the worker waits for its next task meanwhile
        pa.default_memory_pool().release_unused()

    return run


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """The token pieces of every document; only those longer than ``capacity`` are cut. A null text is empty."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(_pieces(tokenizer, end_id, capacity, slice_bytes), PIECES)


def bound_of_counts(count: np.ndarray) -> int:
    """Least number of bins of capacity len(count)-1 that count[n] items of each length n need.

    Two families of dual feasible functions: sizes above capacity - e count
    whole and those below e not at all; and sizes rounded to k-ths.
    """
    capacity = len(count) - 1
    size = np.arange(capacity + 1)
    total, number = np.cumsum(count * size), np.cumsum(count)
    best = -(-int(total[-1]) // capacity)
    e = np.arange(1, capacity // 2 + 1)
    middle = total[capacity - e] - total[e - 1]
    whole = number[capacity] - number[capacity - e]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    for k in range(1, 33):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, k * size, scaled // capacity * capacity)  # in k * capacity-ths
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1)) if len(lengths) else 0


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing over lengths in descending order: (bin, offset) of each, room left in each bin."""
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    room, where, at, mask = [], [], [], 0  # mask: bit r is set if a bin has room r
    for n in lengths.tolist():
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = bins[r].pop()
            if not bins[r]:
                mask &= ~(1 << r)
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        where.append(b)
        at.append(capacity - r)
        r -= n
        room[b] = r
        if r:
            bins[r].append(b)
            mask |= 1 << r
    return np.array(where, np.int64), np.array(at, np.int64), np.array(room, np.int64)


def _packer(round_no: int, capacity: int, final: bool):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row_no"], ascending=[False, True], ignore_index=True)
        where, at, room = best_fit(frame["length"].to_numpy(), capacity)
        bound = lower_bound(frame["length"].to_numpy(), capacity)
        opened = np.zeros(len(room), bool)
        if not final:
            if len(room) == bound:
                opened[np.argmax(room)] = room.max() > 0
            else:
                opened = room > 0
        frame["sequence_id"] = (round_no << 56) + (int(key[0]) << 32) + where
        frame["offset"] = at
        frame["open"] = opened[where]
        frame["bound"] = bound
        return frame.drop(columns=["part"])

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """``items`` (with a column ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Equal lengths are told apart by a row number, so ties and repeated rows do
    no harm. An empty table gives no rows. At most ``ROUNDS`` rounds run; the
    last one seals everything.
    """
    left = keep(items.withColumn("row_no", F.monotonically_increasing_id()), "items")
    schema = ", ".join(f"`{n}` {t}" for n, t in left.dtypes)
    sealed = []
    for round_no in range(ROUNDS):
        parts = max(1, -(-left.count() // partition_rows))
        final = parts == 1 or round_no == ROUNDS - 1
        dealt = left.withColumn("part", F.pmod(F.xxhash64("row_no", F.lit(round_no)), F.lit(parts)))
        done = keep(
            dealt.groupBy("part").applyInPandas(
                _packer(round_no, capacity, final), f"{schema}, sequence_id long, offset long, open boolean, bound long"
            ),
            "packed",
        )
        sealed.append(done.filter("not open"))
        if final:
            break
        left = done.filter("open").drop("sequence_id", "offset", "open", "bound")
    out = sealed[0]
    for more in sealed[1:]:
        out = out.unionByName(more)
    return out.drop("row_no", "open", "bound")


def global_bound(items: DataFrame, capacity: int = CAPACITY) -> int:
    """Lower bound over all items, from their length counts (at most ``capacity`` rows)."""
    count = np.zeros(capacity + 1, np.int64)
    for row in items.groupBy("length").count().collect():
        count[row["length"]] = row["count"]
    return bound_of_counts(count)
