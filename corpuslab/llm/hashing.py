"""Hashes of words and word windows of a batch of texts, as whole-array numpy steps.

All hashes are polynomials modulo 2**64. The hash of any stretch is the
difference of two running sums, divided by a power of the (odd, hence
invertible) base, so one running sum serves every word or window of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
SLICE_BYTES = (1 << 20) - 64  # of text worked on at once; a little below a power of two, which sizes the tables of powers
_powers: dict[tuple[int, bool], np.ndarray] = {}

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 9, 10, 11, 12, 13]] = True
# everything but ASCII letters, digits and the bytes of other scripts
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or those of its inverse."""
    have = _powers.get((base, inverse))
    if have is None or len(have) < n:
        step = pow(base, -1, 1 << 64) if inverse else base
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.full(size, step, U)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 1 << 24:
            _powers[base, inverse] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (splitmix64 finaliser)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _running(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[starts[i]:ends[i]] for every i."""
    sums = _running(values, base)
    return (sums[ends] - sums[starts]) * powers(base, len(values) + 1, inverse=True)[starts]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and the offset at which each begins (one more for the end)."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """Word bounds of a batch: ``starts`` and ``ends`` in ``data``, ``first[d]`` the first word of text d."""

    def __init__(self, texts: pa.Array, separators: np.ndarray = BLANKS):
        self.data, self.offsets = flat(texts)
        inside = ~separators[self.data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(inside))]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
        self.inside = inside
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self, salt: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes; ``salt`` picks one of two unrelated hashes."""
        h = stretches(self.data.astype(U), self.starts, self.ends, BASES[salt])
        return mix(h + (self.ends - self.starts).astype(U) * U(BASES[2]))

    def text_of(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, hashes: np.ndarray, n: int, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every stretch of n words of one text."""
        at = window_starts(self.first, n)
        return at, mix(stretches(hashes, at, at + n, BASES[base]))


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Index of the first word of every stretch of n words that stays in one text."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    return ranges(first[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (counts[0] numbers), then the same of the next."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return np.arange(total) + shift


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i:i+width] for every i with a whole window."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, values.dtype)
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64) if h.dtype == U else h


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each are at most ``most`` bytes together; a longer text stands alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow array of lists from their elements end to end and their lengths."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
