"""Quality of documents by attention over their passages (multiple-instance learning).

A text is a bag of passages of a fixed number of words; all of them are
encoded, from the first word to the last. A passage is described by shares
(capitals, digits, symbols, repeated words ...) and by a hashed bag of its
words, and an encoder layer turns the description into a vector. Gated
attention weighs the passages of a text against one another, and a logistic
layer scores the weighted vector. Encoder, attention and score are trained
together from labels of whole documents: which passages speak for the label is
learnt, not told.

Fitting reads a bounded sample of labelled rows (``Settings.most_rows`` of each
label, whole texts); their passages are described in the tasks, and the driver
holds the descriptions alone (some 300 bytes for each passage).

Defined results: a null, empty or wordless text is one passage without words,
and is scored like any other; repeated rows score alike; labels that are null
do not count. With one label alone every score is near it (0.5 without any).
Columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm import hashing as hx
from corpuslab.llm.store import keep, least_hashed

BUCKETS = 256  # of the hashed bag of words; one byte of the hash
STATS = 16


@dataclass(frozen=True)
class Settings:
    """``most_rows`` of each label bound the sample that is fitted; ``words`` of each passage (255 at most)."""

    most_rows: int = 1_500
    words: int = 64
    width: int = 16
    gate: int = 8
    rounds: int = 150
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 13


@dataclass(frozen=True)
class Model:
    settings: Settings
    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]


def _class(*codes: int) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[list(codes)] = 1
    return table


_CLASSES = (
    _class(*range(65, 91)),  # capitals
    _class(*range(97, 123)),  # small letters
    _class(*range(48, 58)),  # digits
    _class(*b".,;:"),
    _class(*b"!?"),
    _class(*b"#$%&*|<>{}[]=_~^@/\\+"),
    _class(*range(128, 256)),  # other scripts
)
_ENDS = _class(*b".!?") > 0


def _sums_over(values: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(passage, values, n)


def describe(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passages of each text, shares of each passage, counts of each passage's words by bucket)."""
    found = hx.Words(texts)
    first, counts = found.first, found.counts
    number = np.maximum(1, -(-counts // words))
    begin = np.cumsum(number) - number
    n, text = int(number.sum()), found.text_of()
    at = np.arange(len(found.starts)) - first[:-1][text]
    passage = begin[text] + at // words
    hashes = found.hashes()
    shares = np.zeros((n, STATS), np.float32)
    bag = np.zeros((n, BUCKETS), np.uint8)
    if not len(hashes):
        return number, shares, bag
    size = np.bincount(passage, minlength=n).astype(np.float64)
    filled = np.maximum(size, 1)
    length = (found.ends - found.starts).astype(np.float64)
    letters = _sums_over(length, passage, n)
    solid = np.maximum(letters, 1)
    out = [np.log1p(size), letters / filled]
    for table in _CLASSES:
        total = np.zeros(len(found.data) + 1, np.int32)
        np.cumsum(table[found.data], out=total[1:])
        out.append(_sums_over(total[found.ends] - total[found.starts], passage, n) / solid)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    out.append(_sums_over(same, passage, n) / filled)
    order = np.lexsort((hashes, passage))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    out.append(_sums_over(fresh, passage[order], n) / filled)
    # stretches of three words that stand earlier in the same text
    start, stretch = found.windows(hashes, 3)
    order = np.lexsort((start, stretch, text[start]))
    again = np.zeros(len(start), bool)
    again[1:] = (stretch[order][1:] == stretch[order][:-1]) & (text[start[order]][1:] == text[start[order]][:-1])
    out.append(_sums_over(again, passage[start[order]], n) / filled)
    out.append(_sums_over(_ENDS[found.data[found.ends - 1]], passage, n) / filled)
    out.append(_sums_over(length == 1, passage, n) / filled)
    out.append(_sums_over(length > 20, passage, n) / filled)
    lines = np.zeros(len(found.data) + 1, np.int32)
    np.cumsum(found.data == 10, out=lines[1:])
    after = np.append(found.starts[1:], len(found.data))
    last = first[1:][counts > 0] - 1
    after[last] = found.offsets[1:][counts > 0]
    out.append(_sums_over(lines[after] - lines[found.ends], passage, n) / filled)
    shares[:] = np.stack(out, axis=1)
    cells = passage * BUCKETS + (hashes >> hx.U(56)).astype(np.int64)
    bag[:] = np.minimum(np.bincount(cells, minlength=n * BUCKETS), 255).reshape(n, BUCKETS)
    return number, shares, bag


def _inputs(shares: np.ndarray, bag: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised shares beside the roots of the bag's frequencies."""
    total = np.maximum(bag.sum(1, dtype=np.float32), 1)[:, None]
    return np.hstack([np.clip((shares - centre) / scale, -4, 4), np.sqrt(bag / total)]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(x: np.ndarray, number: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    begin = np.cumsum(number) - number
    h = np.tanh(x @ w["encode"] + w["encode_b"])
    tone, gate = np.tanh(h @ w["tone"]), _sigmoid(h @ w["gate"])
    energy = (tone * gate) @ w["pull"]
    energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, begin), number))
    attention = energy / np.repeat(np.add.reduceat(energy, begin), number)
    bag = np.add.reduceat(h * attention[:, None], begin, axis=0)
    return {"h": h, "tone": tone, "gate": gate, "attention": attention, "bag": bag, "odds": bag @ w["score"] + w["score_b"]}


def _gradients(
    x: np.ndarray, number: np.ndarray, label: np.ndarray, share: np.ndarray, w: dict[str, np.ndarray]
) -> dict[str, np.ndarray]:
    f = _forward(x, number, w)
    text = np.repeat(np.arange(len(number)), number)
    begin = np.cumsum(number) - number
    d_odds = ((_sigmoid(f["odds"]) - label) * share).astype(np.float32)
    out = {"score": f["bag"].T @ d_odds, "score_b": d_odds.sum(keepdims=True)}
    d_bag = (d_odds[:, None] * w["score"])[text]
    a, h, tone, gate = f["attention"], f["h"], f["tone"], f["gate"]
    d_a = (h * d_bag).sum(1)
    d_energy = a * (d_a - np.repeat(np.add.reduceat(a * d_a, begin), number))
    out["pull"] = (tone * gate).T @ d_energy
    d_gated = d_energy[:, None] * w["pull"]
    d_tone, d_gate = d_gated * gate * (1 - tone**2), d_gated * tone * gate * (1 - gate)
    out["tone"], out["gate"] = h.T @ d_tone, h.T @ d_gate
    d_h = (a[:, None] * d_bag + d_tone @ w["tone"].T + d_gate @ w["gate"].T) * (1 - h**2)
    out["encode"], out["encode_b"] = x.T @ d_h, d_h.sum(0)
    return out


def fit(number: np.ndarray, shares: np.ndarray, bag: np.ndarray, good: np.ndarray, s: Settings = Settings()) -> Model:
    """Train encoder, gated attention and score together: all bags in each round, both labels with equal weight."""
    rng = np.random.default_rng(s.seed)
    inputs = STATS + BUCKETS
    w = {
        "encode": rng.standard_normal((inputs, s.width)) / np.sqrt(STATS), "encode_b": np.zeros(s.width),
        "tone": rng.standard_normal((s.width, s.gate)) / np.sqrt(s.width),
        "gate": rng.standard_normal((s.width, s.gate)) / np.sqrt(s.width),
        "pull": rng.standard_normal(s.gate) / np.sqrt(s.gate),
        "score": rng.standard_normal(s.width) / np.sqrt(s.width), "score_b": np.zeros(1),
    }
    w = {k: v.astype(np.float32) for k, v in w.items()}
    if not len(good) or good.all() or not good.any():
        level = {True: 5.0, False: -5.0}[bool(good.all())] if len(good) else 0.0
        w["score"], w["score_b"] = w["score"] * 0, np.array([level], np.float32)
        return Model(s, np.zeros(STATS, np.float32), np.ones(STATS, np.float32), w)
    centre, scale = shares.mean(0), shares.std(0) + 1e-3
    x = _inputs(shares, bag, centre, scale)
    label = good.astype(np.float32)
    share = np.where(good, 0.5 / good.sum(), 0.5 / (~good).sum()).astype(np.float32)
    pace, spread = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, s.rounds + 1):
        grads = _gradients(x, number, label, share, w)
        for k, g in grads.items():
            g = g + s.decay * w[k]
            pace[k] = 0.9 * pace[k] + 0.1 * g
            spread[k] = 0.99 * spread[k] + 0.01 * g * g
            move = (pace[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-8)
            w[k] = (w[k] - s.rate * move).astype(np.float32)
    return Model(s, centre, scale, w)


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    """Probability of the good label of each text."""
    if not len(texts):
        return np.zeros(0)
    number, shares, bag = describe(texts, model.settings.words)
    x = _inputs(shares, bag, model.centre, model.scale)
    return _sigmoid(_forward(x, number, model.weights)["odds"].astype(np.float64))


def _described(docs: DataFrame, words: int) -> DataFrame:
    """(h, good, shares, bag) of every row of (text, good, h), as bytes; one row for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hx.slices(batches, "text"):
            number, shares, bag = describe(batch.column("text"), words)
            ends = np.cumsum(number)
            spans = list(zip(ends - number, ends))
            yield pa.record_batch({
                "h": batch.column("h"), "good": batch.column("good"),
                "shares": pa.array([shares[a:b].tobytes() for a, b in spans], pa.binary()),
                "bag": pa.array([bag[a:b].tobytes() for a, b in spans], pa.binary()),
            })

    return docs.select("h", "good", "text").mapInArrow(run, "h long, good boolean, shares binary, bag binary")


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Fit on the labelled rows of ``docs`` (doc_id, text) whose ids have the least hashes, ``most_rows`` of each label.

    The ids are picked from ``labels`` (doc_id, good) alone, so one pass over
    the texts describes the sample; the bound holds again for the rows found,
    should an id stand in many.
    """
    known = labels.filter("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(F.min("good").alias("good"))
    known = known.withColumn("h", F.xxhash64("doc_id"))
    picked = None
    for label in (False, True):
        some = least_hashed(known.filter(F.col("good") == label), "h", s.most_rows).select("doc_id", "good")
        picked = some if picked is None else picked.unionByName(some)
    # the join side is bounded by twice most_rows ids
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    rows = texts.join(F.broadcast(picked), "doc_id").select(
        "good", "text", F.xxhash64("doc_id", "text").alias("h")
    )
    sample = keep(_described(rows, s.words), "passages")
    found = []
    for label in (False, True):
        found += least_hashed(sample.filter(F.col("good") == label), "h", s.most_rows).collect()
    found.sort(key=lambda r: (r.h, bytes(r.bag)))
    good = np.array([r.good for r in found], bool)
    shares = np.frombuffer(b"".join(r.shares for r in found), np.float32).reshape(-1, STATS)
    bag = np.frombuffer(b"".join(r.bag for r in found), np.uint8).reshape(-1, BUCKETS)
    number = np.array([len(r.bag) // BUCKETS for r in found], np.int64)
    return fit(number, shares, bag, good, s)


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, score) of every row. The model goes to the tasks as some 20 KB, however much text there is."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hx.slices(batches, "text"):
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "score": pa.array(score_texts(batch.column("text"), held.value))
            })

    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
