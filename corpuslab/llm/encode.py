"""Token ids of whole texts by a public tokenizer file, each distinct word encoded once.

A word-level tokenizer never joins characters across blanks, so the ids of a
text are those of its words in order. A task keeps the ids of words it has met.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from corpuslab.llm.hashing import Words, flat, ranges

REMEMBERED = 400_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".,;:!?"]] = True
# Latin letters that no normal form changes but for their case
_PLAIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


def _strings(words: pa.Array) -> list[str]:
    """The strings of an array of words without blanks, decoded in one go."""
    data, offsets = flat(words)
    if len(words) == 0:
        return []
    out = np.full(len(data) + len(words), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(words)), np.diff(offsets))] = data
    return out[:-1].tobytes().decode().split(" ")


class WordEncoder:
    """``word_bpe_49k.json`` or another file whose pre-tokenizer splits at blanks and whose normaliser lower-cases."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        bytes_of = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.mapped = {ord(c): bytes_of(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if _PLAIN(c)}
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _ids(self, words: list[str]) -> tuple[list[int], list[int]]:
        """(ids end to end, number of ids of each word). Words of plain letters are one piece for the model as they
        stand; all others go through the tokenizer's own normaliser and pre-tokenizer."""
        ids, counts, tokenize = [], [], self.tokenizer.model.tokenize
        for word in words:
            if _PLAIN(word):
                made = [t.id for t in tokenize(word if word.isascii() else word.lower().translate(self.mapped))]
            else:
                made = self.tokenizer.encode(word, add_special_tokens=False).ids
            ids += made
            counts.append(len(made))
        return ids, counts

    def _learn(self, words: list[str]) -> None:
        ids, counts = self._ids(words)
        need, known = self.used + len(ids), len(self.place)
        while need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while known + len(words) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.ids[self.used : need] = ids
        self.lengths[known : known + len(words)] = counts
        self.starts[known : known + len(words)] = self.used + np.cumsum(counts) - counts
        self.place.update(zip(words, range(known, known + len(words)), strict=True))
        self.used = need

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each text); a null text has none."""
        # lower-casing ASCII letters first, and parting a stop from the letter or digit before it, change no id
        # and let more words be equal
        found = Words(texts)
        data = found.data
        parts = np.flatnonzero(_STOPS[data[1:]] & _ALNUM[data[:-1]]) + 1 if len(data) else np.zeros(0, np.int64)
        parts = parts[~np.isin(parts, found.offsets)]
        opens = np.zeros(len(data), bool)
        opens[found.starts] = opens[parts] = True
        begins = np.flatnonzero(opens)
        inside = np.concatenate([[0], np.cumsum(found.inside)])
        bounds = np.append(inside[begins], inside[-1])
        packed = _LOWER[data[found.inside]]
        coded = pa.LargeStringArray.from_buffers(
            len(begins), pa.py_buffer(bounds), pa.py_buffer(packed)
        ).dictionary_encode()
        words = _strings(coded.dictionary)
        if len(self.place) + len(words) > REMEMBERED:
            self._forget()
        place = list(map(self.place.get, words))
        new = [i for i, p in enumerate(place) if p is None]
        if new:
            known = len(self.place)
            self._learn([words[i] for i in new])
            for i, at in zip(new, range(known, known + len(new)), strict=True):
                place[i] = at
        at = np.array(place, np.int64)[np.asarray(coded.indices, np.int64)] if len(words) else np.zeros(0, np.int64)
        lengths = self.lengths[at]
        ids = self.ids[ranges(self.starts[at], lengths)]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(sums[np.searchsorted(begins, found.offsets)])

    def with_end(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after each text; second result: bounds, one more than texts."""
        ids, counts = self.encode(texts)
        bounds = np.concatenate([[0], np.cumsum(counts + 1)])
        out = np.full(bounds[-1], end_id, np.uint32)
        inside = np.ones(len(out), bool)
        inside[bounds[1:] - 1] = False
        out[inside] = ids
        return out, bounds
