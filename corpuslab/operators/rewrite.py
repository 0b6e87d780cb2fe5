"""Rewriting word arrays where they stand: words replaced, neighbours joined, nothing shuffled.

The table of what changes (lemmas, accepted pairs) is measured. Up to
``WHOLE_BYTES`` it goes to every task whole, and arrays are rewritten inside
their rows, a batch at a time. Callers keep a way by joins beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from corpuslab.functions import stem
from corpuslab.session import measured

WHOLE_BYTES = 32 << 20


def whole(table: DataFrame) -> tuple[DataFrame, pa.Table | None]:
    """``table`` written, and its rows if they are few enough to be sent to every task."""
    written, size = measured(table)
    return written, written.toArrow().combine_chunks() if size <= WHOLE_BYTES else None


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return pa.concat_arrays(column.chunks).cast(pa.string()) if column.num_chunks else pa.array([], pa.string())


def _relisted(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _words(batch: pa.RecordBatch, name: str) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch end to end, and the number in each row; a null array has none."""
    column = batch.column(name)
    return column.flatten().cast(pa.string()), np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)


def replaced(rows: DataFrame, mapping: pa.Table, keys: Sequence[str], words: str) -> DataFrame:
    """``keys`` and ``words`` with every word that ``mapping`` (word, lemma) holds replaced; null words give none."""
    held = rows.sparkSession.sparkContext.broadcast((_column(mapping, "word"), _column(mapping, "lemma")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lemmas = held.value
        for batch in batches:
            values, lengths = _words(batch, words)
            at = pc.index_in(values, known)
            changed = pc.if_else(pc.is_valid(at), lemmas.take(at), values) if len(known) else values
            yield pa.record_batch([*[batch.column(k) for k in keys], _relisted(changed, lengths)], [*keys, words])

    chosen = rows.select(*keys, words)
    return chosen.mapInArrow(run, chosen.schema)


def stemmed(rows: DataFrame, words: str = "words") -> DataFrame:
    """``rows`` with every word of the array ``words`` stemmed; null arrays stay null.

    A batch's distinct words are stemmed, once each, so the cost of a step
    grows with the words that differ and not with the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, lengths = _words(batch, words)
            coded = values.dictionary_encode()
            stems = pa.array([stem.stemmed(w) for w in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
            missing = np.asarray(pc.is_null(batch.column(words)))
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            made = pa.ListArray.from_arrays(offsets, stems, mask=pa.array(missing))
            yield pa.record_batch([made if n == words else batch.column(n) for n in batch.schema.names], batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


# Names that each batch looks up anew; more are put into a dict once for each task.
FEW_NAMES = 1 << 17


class _Places:
    """Places of words in ``names``; -1 where there is none. Each distinct word of a batch is looked up once."""

    def __init__(self, names: pa.Array):
        self.names = names
        self.known = {n: i for i, n in enumerate(names.to_pylist())} if len(names) > FEW_NAMES else None

    def of(self, values: pa.Array) -> np.ndarray:
        coded = values.dictionary_encode()
        if self.known is None:
            found = np.asarray(pc.fill_null(pc.index_in(coded.dictionary, self.names), -1), np.int64)
        else:
            found = np.array([self.known.get(w, -1) for w in coded.dictionary.to_pylist()], np.int64)
        return np.append(found, -1)[np.asarray(pc.fill_null(coded.indices, len(found)), np.int64)]

    def codes(self, first: pa.Array, second: pa.Array) -> np.ndarray:
        """One number for each pair of words."""
        return self.of(first) * len(self.names) + self.of(second)


Pairs = tuple[pa.Array, np.ndarray]


def whole_pairs(pairs: DataFrame) -> tuple[DataFrame, Pairs | None]:
    """``pairs`` (first, second) written, and their distinct words and sorted codes if these are few enough to be sent to every task.

    A word is sent once and a pair as one number, so many times more pairs fit than as text.
    """
    written, table = whole(pairs.select("first", "second").filter("first IS NOT NULL AND second IS NOT NULL"))
    if table is not None:
        first, second = _column(table, "first"), _column(table, "second")
        names = pa.concat_arrays([first, second]).unique()
        return written, (names, np.unique(_Places(names).codes(first, second)))
    number = written.count() * 8
    if number > WHOLE_BYTES:
        return written, None
    listed, size = measured(written.select("first").union(written.select("second")).distinct())
    if number + size > WHOLE_BYTES:
        return written, None
    names = _column(listed.toArrow(), "first")
    held = pairs.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(held.value)
        for batch in batches:
            codes = places.codes(*(batch.column(n).cast(pa.string()) for n in ("first", "second")))
            yield pa.record_batch([pa.array(codes, pa.int64())], ["code"])

    codes = written.mapInArrow(run, "code long").toArrow().column("code")
    return written, (names, np.unique(np.asarray(codes)))


def joined_pairs(rows: DataFrame, pairs: Pairs, keys: Sequence[str], words: str) -> DataFrame:
    """``keys`` and ``words`` with accepted pairs joined by an underscore, left to right without overlap.

    ``pairs`` come from ``whole_pairs``. Of neighbouring pairs that all
    qualify, every other one from the start of their run is joined: what a loop
    from left to right would choose.
    """
    held = rows.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, accepted = held.value
        known = _Places(names)
        for batch in batches:
            values, lengths = _words(batch, words)
            n = len(values)
            if n < 2 or not len(accepted):
                yield pa.record_batch([*[batch.column(k) for k in keys], _relisted(values, lengths)], [*keys, words])
                continue
            row = np.repeat(np.arange(len(lengths)), lengths)
            at = known.of(values)
            hit = np.append((row[1:] == row[:-1]) & (at[1:] >= 0) & (at[:-1] >= 0), False)
            likely = np.nonzero(hit)[0]
            code = at[likely] * len(names) + at[likely + 1]
            hit[likely] = accepted[np.minimum(np.searchsorted(accepted, code), len(accepted) - 1)] == code
            place = np.arange(n)
            # the last place at or before each that starts no pair
            miss = np.maximum.accumulate(np.where(hit, -1, place))
            first = np.concatenate([[0], np.cumsum(lengths)])[row]
            chosen = hit & ((place - np.maximum(miss, first - 1) - 1) % 2 == 0)
            consumed = np.append(False, chosen[:-1])
            begun = np.nonzero(chosen)[0]
            pair = pc.binary_join_element_wise(values.take(pa.array(begun)), values.take(pa.array(begun + 1)), "_")
            made = pc.replace_with_mask(values, pa.array(chosen), pair).filter(pa.array(~consumed))
            left = np.bincount(row[~consumed], minlength=len(lengths))
            yield pa.record_batch([*[batch.column(k) for k in keys], _relisted(made, left)], [*keys, words])

    chosen = rows.select(*keys, words)
    return chosen.mapInArrow(run, chosen.schema)

