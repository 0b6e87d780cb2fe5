"""Toxicity scores from subword-bag embeddings under a linear softmax.

A word is the mean of the embeddings of its character n-grams (in UTF-8 bytes,
with marks at both ends), a window of consecutive words the mean of its words,
and a softmax over two classes sits on top. Embeddings and softmax are trained
together. A text is as toxic as its most toxic window, so that one insult in a
long text is not averaged away; training feeds back through that window. New
spellings share n-grams with known ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm import hashing as hx
from corpuslab.llm.store import least_hashed


@dataclass(frozen=True)
class Settings:
    """``most_rows`` of each label and ``most_bytes`` of each text bound the sample that is fitted; the texts are
    whole. ``buckets`` n-gram vectors of ``width`` numbers; n-grams of ``least`` to ``longest`` bytes."""

    most_rows: int = 1_500
    most_bytes: int = 4_000
    buckets_log2: int = 20
    width: int = 4
    least: int = 3
    longest: int = 5
    window: int = 4
    warm_rounds: int = 10
    rounds: int = 40
    rate: float = 2.0
    seed: int = 20


@dataclass(frozen=True)
class Model:
    settings: Settings
    embeddings: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def gram_scores(self) -> np.ndarray:
        """What each n-gram adds to the odds of the toxic class: all that scoring needs of the embeddings."""
        return self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Spelled:
    """The distinct words of a batch, each between two marks, and which of them stands where."""

    def __init__(self, texts: pa.Array):
        self.words = hx.Words(texts, hx.NOT_ALNUM)
        bounds = np.concatenate([[0], np.cumsum(self.words.ends - self.words.starts)])
        packed = _LOWER[self.words.data[self.words.inside]]
        coded = pa.LargeStringArray.from_buffers(
            len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(packed)
        ).dictionary_encode()
        self.word = np.asarray(coded.indices, np.int64)
        letters, offsets = hx.flat(coded.dictionary)
        lengths = np.diff(offsets)
        self.begins = np.concatenate([[0], np.cumsum(lengths + 2)])
        self.data = np.full(self.begins[-1], 1, np.uint8)
        body = np.ones(len(self.data), bool)
        body[self.begins[:-1]] = False
        body[self.begins[1:] - 1] = False
        self.data[body] = letters

    def grams(self, s: Settings) -> tuple[np.ndarray, np.ndarray]:
        """(buckets of all n-grams, word by word; where each word's begin): n-grams of every length and the whole word."""
        data, begins = self.data, self.begins
        left = np.repeat(begins[1:], np.diff(begins)) - np.arange(len(data))  # bytes to the word's end
        key, sizes = data.astype(hx.U), range(s.least, s.longest + 1)
        number = np.clip(np.diff(begins)[:, None] - np.array(sizes) + 1, 0, None)
        bounds = np.concatenate([[0], np.cumsum(number.sum(1) + 1)])
        out = np.empty(bounds[-1], np.int64)
        shift = hx.U(64 - s.buckets_log2)
        # whole words are last
        out[bounds[1:] - 1] = hx.mix(hx.stretches(key, begins[:-1], begins[1:], hx.BASES[0])) >> shift
        place = bounds[:-1].copy()
        for n in range(2, s.longest + 1):
            if len(data) >= n:
                key[: len(data) - n + 1] |= data[n - 1 :].astype(hx.U) << hx.U(8 * (n - 1))
            if n >= s.least:
                at = np.flatnonzero(left >= n)
                salted = (key[at] + hx.U(n)) * hx.U(hx.BASES[0])
                salted ^= salted >> hx.U(29)
                counts = number[:, n - s.least]
                out[hx.ranges(place, counts)] = salted * hx.U(hx.BASES[1]) >> shift
                place += counts
        return out, bounds


def _window_bounds(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, text) of every window; a shorter text is one window, one without words has none."""
    counts = np.diff(first)
    number = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    at = hx.ranges(first[:-1], number)
    text = np.repeat(np.arange(len(counts)), number)
    return at, np.minimum(at + width, first[1:][text]), text


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def fit(texts: list[str], toxic: np.ndarray, s: Settings = Settings()) -> Model:
    """Train embeddings and softmax together by gradient descent with momentum, all texts in each round."""
    rng = np.random.default_rng(s.seed)
    size = 1 << s.buckets_log2
    emb = np.zeros((size, s.width), np.float32)
    soft = (rng.standard_normal((s.width, 2)) / np.sqrt(s.width)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    spelled = _Spelled(pa.array([t.lower() for t in texts], pa.string()))
    words, word = spelled.words, spelled.word
    if not len(word) or toxic.min() == toxic.max():
        return Model(s, emb * 0, soft, np.array([5.0, 0.0], np.float32))
    bucket, bounds = spelled.grams(s)
    used, bucket = np.unique(bucket, return_inverse=True)  # only buckets that occur are trained
    number = np.diff(bounds)
    of = np.repeat(np.arange(len(number)), number)
    at, end, text = _window_bounds(words.first, s.window)
    span = (end - at).astype(np.float32)
    windows = np.bincount(text, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(windows)])[:-1]
    full = np.flatnonzero(windows)
    label = toxic[text].astype(np.int64)
    share = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))  # both classes weigh the same
    p = [emb[used].astype(np.float32), soft, bias]
    pace = [np.zeros_like(x) for x in p]
    for step in range(1, s.rounds + 1):
        e, w, b = p
        bags = np.empty((len(at), s.width), np.float32)
        for k in range(s.width):
            vectors = np.add.reduceat(e[:, k][bucket], bounds[:-1]) / number
            bags[:, k] = _sums(vectors[word], at, end) / span
        logits = bags @ w + b
        odds = logits[:, 1] - logits[:, 0]
        top = np.maximum.reduceat(odds, begin[full])
        best = np.zeros(len(odds), bool)
        best[np.flatnonzero(odds >= np.repeat(top, windows[full]))] = True
        even = share[text] / windows[text]
        if step <= s.warm_rounds:
            weight = even
        else:  # a clean text is clean everywhere, a toxic one somewhere
            best_share = share[text] * best / np.add.reduceat(best, begin[full])[np.searchsorted(full, text)]
            weight = np.where(label == 1, best_share, 0.5 * even + 0.5 * best_share)
        shifted = np.exp(logits - logits.max(1, keepdims=True))
        grad = shifted / shifted.sum(1, keepdims=True)
        grad[np.arange(len(label)), label] -= 1
        grad = (grad * weight[:, None]).astype(np.float32)
        d_bags = (grad @ w.T) / span[:, None]
        edges = np.zeros((len(word) + 1, s.width))
        for k in range(s.width):
            edges[:, k] = np.bincount(at, d_bags[:, k], len(word) + 1) - np.bincount(end, d_bags[:, k], len(word) + 1)
        d_tokens = np.cumsum(edges, axis=0)[:-1]
        d_e = np.empty_like(e)
        for k in range(s.width):
            d_word = np.bincount(word, d_tokens[:, k], len(number)) / number
            d_e[:, k] = np.bincount(bucket, d_word[of], len(used))
        # steps in proportion to the evidence, so that a gram of one text does not move like one of hundreds;
        # the largest is ``rate``, and the softmax moves a hundredth of that
        for i, (g, most) in enumerate(((d_e, s.rate), (bags.T @ grad, s.rate / 100), (grad.sum(0), s.rate / 100))):
            pace[i] = 0.8 * pace[i] + 0.2 * g
            p[i] = (p[i] - most * pace[i] / max(float(np.abs(pace[i]).max()), 1e-12)).astype(np.float32)
    out = np.zeros((size, s.width), np.float32)  # n-grams never seen say nothing
    out[used] = p[0]
    return Model(s, out, p[1], p[2])


def score_texts(texts: pa.Array, gram_scores: np.ndarray, bias: float, s: Settings) -> np.ndarray:
    """Probability of the toxic class of each (lower-cased) text; 0 without a word."""
    spelled, out = _Spelled(texts), np.zeros(len(texts))
    words = spelled.words
    if not len(spelled.word):
        return out
    bucket, bounds = spelled.grams(s)
    scores = np.add.reduceat(gram_scores[bucket], bounds[:-1]) / np.diff(bounds)
    at, end, text = _window_bounds(words.first, s.window)
    odds = _sums(scores[spelled.word], at, end) / (end - at)
    windows = np.bincount(text, minlength=len(texts))
    full = np.flatnonzero(windows)
    begin = np.concatenate([[0], np.cumsum(windows)])[:-1][full]
    out[full] = 1 / (1 + np.exp(-np.clip(np.maximum.reduceat(odds, begin) + bias, -50, 50)))
    return out


def train(labelled: DataFrame, s: Settings = Settings()) -> Model:
    """Fit on a bounded sample of (key, text, toxic) rows: of each label the rows with the least hashes of key."""
    fits = labelled.filter(
        F.col("text").isNotNull() & F.col("toxic").isNotNull() & (F.octet_length("text") <= s.most_bytes)
    ).select(F.lower("text").alias("text"), (F.col("toxic") == 1).alias("toxic"),
             F.xxhash64(F.col("key").cast("string"), "text").alias("h"))
    rows = []
    for label in (False, True):
        rows += least_hashed(fits.filter(F.col("toxic") == label), "h", s.most_rows).collect()
    if not rows:
        return fit([""], np.zeros(1, bool), s)
    return fit([r.text for r in rows], np.array([r.toxic for r in rows], bool), s)


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, score) of every row; a null or wordless text scores 0. Other columns are not read.

    The model goes to the tasks as one number for each n-gram bucket, 4 MiB
    however much text there is.
    """
    s, bias = model.settings, float(model.bias[1] - model.bias[0])
    table = docs.sparkSession.sparkContext.broadcast(model.gram_scores().astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hx.slices(batches, "text"):
            scores = score_texts(batch.column("text"), table.value, bias, s)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(scores)})

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.lower(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
