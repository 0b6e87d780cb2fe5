"""Near-duplicate groups: improved consistent weighted sampling over TF-IDF shingles.

A shingle is five words; its weight in a text is its count times the mean
inverse document frequency of its words. (Taken from the shingle itself, the
frequency would fall with the number of copies, and large groups of copies
would look less alike than small ones.) Sixty consistent weighted samples in
bands of four bring texts together whose weighted Jaccard similarity is 0.8 or
more with probability above 0.9995; every link is then checked by the exact
similarity of the whole texts.

Copies of a text are one node. Inside a band's bucket no pair list is made:
members are compared to a few hubs first (those that meet most others), and
links to them join most of a group. What is left of a bucket, the members that
are not in its largest group, is compared with all its members of other groups,
block by block inside the tasks: by samples first, then, where samples agree,
by whole texts. A block gives out only the links that join two groups, so what
moves grows with the members and not with their pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.llm import hashing as hx
from corpuslab.llm.graph import components
from corpuslab.llm.store import keep
from corpuslab.session import lookup

SLICE_BYTES = (1 << 19) - 64  # of text that a worker holds hashes of at once
BUCKETS = 1 << 18  # of words, for document frequencies: a table of fixed size


@dataclass(frozen=True)
class Settings:
    """``least``: similarity of a link. ``agree``: samples that must agree before two texts are compared,
    well below what ``least`` lets expect (48 of 60, with a deviation of 3.1). ``block``: members of a bucket that
    are compared with as many others at once, with about ``block_bytes`` of text."""

    words: int = 5
    bands: int = 15
    rows: int = 4
    least: float = 0.8
    agree: int = 34
    hubs: int = 8
    block: int = 512
    block_bytes: int = 200 << 10

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> hx.U(64 - 18)).astype(np.int64)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold a word of each bucket, one sum per task."""
    total, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in hx.slices(batches, "text", SLICE_BYTES):
        words = hx.Words(batch.column("text"))
        pairs = np.unique(words.text_of() * BUCKETS + _buckets(words.hashes()))
        total += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
        texts += batch.num_rows
    at = np.flatnonzero(total)
    yield pa.record_batch({"bucket": pa.array(np.append(at, -1)), "n": pa.array(np.append(total[at], texts))})


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """1 + ln((texts + 1) / (texts with a word of the bucket + 1)), for each of the ``BUCKETS`` buckets."""
    rows = docs.select("text").mapInArrow(_word_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = rows.toPandas()  # at most one row for each bucket
    total = int(got.loc[got["bucket"] < 0, "n"].sum())
    df = np.zeros(BUCKETS)
    got = got[got["bucket"] >= 0]
    df[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return (1 + np.log((total + 1) / (df + 1))).astype(np.float32)


def weighted_shingles(words: hx.Words, idf: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight), sorted by text and shingle; a text of fewer words is one shingle."""
    hashes = words.hashes()
    number = np.where(words.counts > 0, np.maximum(words.counts - size + 1, 1), 0)
    at = hx.ranges(words.first[:-1], number)
    text = np.repeat(np.arange(len(number)), number)
    end = np.minimum(at + size, words.first[1:][text])
    shingle = hx.mix(hx.stretches(hashes, at, end, hx.BASES[1]))
    sums = np.concatenate([[0], np.cumsum(idf[_buckets(hashes)], dtype=np.float64)])
    order = np.lexsort((shingle, text))
    text, shingle, at, end = text[order], shingle[order], at[order], end[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, len(text)))
    # rounded, so that a shingle's weight does not depend on where in a batch it stands
    mean = np.round((sums[end[begin]] - sums[at[begin]]) / np.maximum(end[begin] - at[begin], 1), 4)
    return text[begin], shingle[begin], times * mean


@lru_cache(maxsize=2)
def _tables(samples: int) -> list[tuple[np.ndarray, ...]]:
    """For each sample the draws of consistent weighted sampling: r and c gamma(2, 1), b uniform; 16,384 of each.

    Shingles that share a draw are told apart by their order, which is the same in every text.
    """
    out = []
    for k in range(samples):
        rng = np.random.default_rng([k, 60])
        r = rng.gamma(2.0, 1.0, 1 << 14).astype(np.float32)
        c = np.log(rng.gamma(2.0, 1.0, 1 << 14)).astype(np.float32)
        b = rng.random(1 << 14, np.float32)
        out.append((r, (1 / r).astype(np.float32), b, c, hx.U(int(rng.integers(1 << 62)) * 2 + 1)))
    return out


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, tables: list) -> np.ndarray:
    """One row of samples for each text that has a shingle: a hash of (shingle, t) with the least ln a."""
    begin = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begin, len(text)))
    log_weight = np.log(weight).astype(np.float32)
    out = np.empty((len(begin), len(tables)), np.uint32)
    for k, (r, inverse, b, c, odd) in enumerate(tables):
        draw = ((shingle * odd) >> hx.U(50)).astype(np.int64)
        rr, bb = r[draw], b[draw]
        t = np.floor(log_weight * inverse[draw] + bb)
        value = c[draw] - rr * (t - bb + np.float32(1))
        least = np.minimum.reduceat(value, begin) if len(begin) else value
        at = np.flatnonzero(value == np.repeat(least, sizes))
        # shingles are in order, so the first of equals is the same in every text
        owner = np.searchsorted(begin, at, side="right") - 1
        first = at[np.append(True, owner[1:] != owner[:-1])] if len(at) else at
        sample = hx.mix(shingle[first] + t[first].astype(np.int64).view(hx.U) * hx.U(hx.BASES[2]))
        out[:, k] = (sample >> hx.U(32)).astype(np.uint32)
    return out


def _signer(idf, s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(s.samples)
        for batch in hx.slices(batches, "text", SLICE_BYTES):
            words = hx.Words(batch.column("text"))
            text, shingle, weight = weighted_shingles(words, idf.value, s.words)
            signed = signatures(text, shingle, weight, tables)
            full = words.counts > 0
            digests = [hashlib.sha256((x or "").encode()).digest()[:16] for x in batch.column("text").to_pylist()]
            lengths = np.where(full, s.samples, 0)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "digest": pa.array(digests, pa.binary()),
                "samples": hx.list_array(signed.ravel().view(np.int32), lengths, pa.int32()),
            })

    return run


def similarity(left: pa.Array, right: pa.Array, idf: np.ndarray, size: int) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts; 0 where both have no word."""
    n = len(left)
    words = hx.Words(pa.concat_arrays([left.cast(pa.large_string()), right.cast(pa.large_string())]))
    text, shingle, weight = weighted_shingles(words, idf, size)
    pair = text % n
    order = np.lexsort((text, shingle, pair))
    pair, shingle, weight = pair[order], shingle[order], weight[order]
    both = np.flatnonzero((pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1]))
    common = np.bincount(pair[both], np.minimum(weight[both], weight[both + 1]), n)
    total = np.bincount(pair, weight, n) - common
    return np.divide(common, total, out=np.zeros(n), where=total > 0)


def _compared(idf, size: int):
    """(a, b, similarity) of (a, b, ta, tb), some 1 MiB of texts at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = sum(hx.flat(batch.column(c))[1][1:] for c in ("ta", "tb"))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right")))
                part = batch.slice(at, to - at)
                found = similarity(part.column("ta"), part.column("tb"), idf.value, size)
                yield pa.record_batch({"a": part.column("a"), "b": part.column("b"), "similarity": pa.array(found)})
                at = to

    return run


class _Comparer:
    """Similarity of node pairs: first by samples, then by whole texts."""

    def __init__(self, nodes: DataFrame, docs: DataFrame, wanted: DataFrame, idf, s: Settings):
        self.s, self.measure = s, _compared(idf, s.words)
        self.samples = nodes.select("node", "samples")
        digests = lookup(nodes.join(wanted, "node").select("digest", "node"))
        self.texts = keep(
            docs.select(F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), 1, 16).alias("digest"), "text")
            .join(digests, "digest").groupBy("node").agg(F.first("text").alias("text")),
            "texts",
        )

    def promising(self, pairs: DataFrame) -> DataFrame:
        """Those (a, b, ...) whose samples agree often enough."""
        x = self.samples.select(F.col("node").alias("a"), F.col("samples").alias("sa"))
        y = self.samples.select(F.col("node").alias("b"), F.col("samples").alias("sb"))
        equal = F.size(F.filter(F.zip_with("sa", "sb", lambda p, q: p == q), lambda e: e))
        return pairs.join(x, "a").join(y, "b").filter(equal >= self.s.agree).select(*pairs.columns)

    def settle(self, near: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(all measured pairs, links) of the pairs (a, b, worth).

        First every node meets its worthiest partner. Pairs that these links
        join are known to be in one group; only the others are measured too.
        """
        best = near.groupBy("a").agg(F.max(F.struct("worth", (-F.col("b")).alias("minus"))).alias("h")).select(
            "a", (-F.col("h.minus")).alias("b")
        )
        first = self.measured(best)
        ties = first.filter(F.col("similarity") >= self.s.least)
        rest = near.select("a", "b").join(first.select("a", "b"), ["a", "b"], "left_anti")
        second = self.measured(_apart(rest, components(ties.select("a", "b"))))
        every = first.unionByName(second)
        return every, every.filter(F.col("similarity") >= self.s.least)

    def measured(self, pairs: DataFrame) -> DataFrame:
        x = self.texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
        y = self.texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
        return keep(
            pairs.join(x, "a").join(y, "b").select("a", "b", "ta", "tb").mapInArrow(
                self.measure, "a long, b long, similarity double"
            ),
            "measured",
        )


def links(nodes: DataFrame, docs: DataFrame, idf, s: Settings) -> DataFrame:
    """Checked links (a, b, similarity) that join all nodes that a bucket brings together."""
    spark = docs.sparkSession
    band = F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(s.bands - 1)),
        lambda i: F.xxhash64(i, F.slice("samples", i * s.rows + 1, F.lit(s.rows))),
    ))
    each = nodes.filter(F.size("samples") > 0).select("node", band.alias("key"))
    shared = each.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = keep(each.join(shared, "key"), "members")
    none = spark.createDataFrame([], "a long, b long, similarity double")
    if members.isEmpty():
        return none
    # nodes that meet many others are hubs first
    rank = members.groupBy("node").agg(F.sum("n").alias("rank"))
    everyone = keep(members.join(rank, "node").select("key", "node", "rank"), "active")
    compare = _Comparer(nodes, docs, rank.select("node"), idf, s)
    found = tested = none
    roots, active = spark.createDataFrame([], "node long, root long"), everyone
    for lots in (1, s.hubs):
        if active.isEmpty():
            break
        lot = F.pmod(F.xxhash64("node"), F.lit(lots))
        hubs = active.groupBy("key", lot.alias("lot")).agg(F.max(F.struct("rank", (-F.col("node")).alias("minus"))).alias("h"))
        hubs = lookup(hubs.select("key", (-F.col("h.minus")).alias("hub"), F.col("h.rank").alias("worth")))
        meet = active.join(hubs, "key").filter("node <> hub").select(
            F.col("node").alias("a"), F.col("hub").alias("b"), "worth"
        ).distinct()
        fresh = _apart(meet.join(tested.select("a", "b"), ["a", "b"], "left_anti"), roots)
        done, ties = compare.settle(keep(compare.promising(fresh), "near"))
        tested, found = tested.unionByName(done), found.unionByName(ties)
        roots = components(found.select("a", "b"))
        active = keep(_left_over(active, hubs, roots), "active")
    return found.unionByName(_block_links(everyone.select("key", "node"), compare, roots, idf, s))


def _block_links(members: DataFrame, compare: _Comparer, roots: DataFrame, idf, s: Settings) -> DataFrame:
    """Links (a, b, similarity) that join groups of a bucket which the hubs left apart.

    Of each bucket the members outside its largest group meet all members of
    other groups. Both sides are cut into blocks by number and by bytes of
    text; two blocks are one row, and samples decide which of their members
    have texts to be compared at all.
    """
    sizes = compare.texts.select("node", F.octet_length("text").cast("bigint").alias("bytes"))
    rows = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    groups = rows.groupBy("key", "root").agg(F.count("*").alias("n"))
    largest = groups.groupBy("key").agg(
        F.max(F.struct("n", (-F.col("root")).alias("minus"))).alias("g"), F.count("*").alias("groups")
    ).filter("groups > 1").select("key", (-F.col("g.minus")).alias("largest"))
    rows = keep(
        rows.join(largest, "key").join(sizes, "node").select(
            "key", "node", "root", "bytes", (F.col("root") != F.col("largest")).alias("left")
        ),
        "split",
    )

    def blocks(here: Column) -> Column:
        count, size = F.count(F.when(here, 1)), F.coalesce(F.sum(F.when(here, F.col("bytes"))), F.lit(0))
        return F.greatest(F.ceil(count / s.block), F.ceil(size / s.block_bytes), F.lit(1)).cast("int")

    cuts = rows.groupBy("key").agg(blocks(F.col("left")).alias("lefts"), blocks(F.lit(True)).alias("alls"))
    placed = rows.join(cuts, "key").join(compare.samples, "node")
    pair = ["key", "low", "high"]

    def packed(members: DataFrame, count: str, block: str, asks: bool) -> DataFrame:
        """A row for each block of a bucket: members are packed first, so that whole blocks meet and no row of theirs is repeated."""
        number = F.pmod(F.xxhash64("node"), F.col(count)).cast("int").alias(block)
        member = F.struct(F.lit(asks).alias("asks"), "node", "root", "left", "samples").alias("member")
        return members.select("key", number, member).groupBy("key", block).agg(F.collect_list("member").alias(f"{block}_rows"))

    met = packed(placed.filter("left"), "lefts", "low", True).join(packed(placed, "alls", "high", False), "key").select(
        *pair, F.concat("low_rows", "high_rows").alias("rows")
    )
    schema = "key long, low int, high int, asks boolean, node long, root long, left boolean"
    close = keep(met.mapInArrow(_agreeing(s), schema), "close")
    member = F.struct("asks", "node", "root", "left", "samples", "text").alias("member")
    texts = close.join(compare.texts, "node").join(compare.samples, "node").select(*pair, member).groupBy(*pair).agg(
        F.collect_list("member").alias("rows")
    )
    return keep(texts.mapInArrow(_joining(idf, s), "a long, b long, similarity double"), "joined")


class _Pair:
    """Two blocks of a bucket: who asks (``ask``), who is asked (``rest``), and whose samples agree."""

    def __init__(self, rows: pa.StructArray, s: Settings):
        asks, self.node, self.root, self.left = (rows.field(n).to_numpy(zero_copy_only=False) for n in ("asks", "node", "root", "left"))
        self.samples = rows.field("samples").flatten().to_numpy().reshape(len(asks), s.samples)
        self.ask, self.rest = np.flatnonzero(asks), np.flatnonzero(~asks)
        self.least = s.agree

    def agreeing(self, i: int, root: np.ndarray) -> np.ndarray:
        """Those asked that ``i`` may be linked to: other groups, and of two that both ask the one with the greater number."""
        rest = self.rest
        rest = rest[(root[rest] != root[i]) & (~self.left[rest] | (self.node[rest] > self.node[i]))]
        return rest[(self.samples[rest] == self.samples[i]).sum(1) >= self.least]


def _pairs_of_blocks(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[tuple[pa.RecordBatch, int, pa.StructArray, _Pair]]:
    for batch in batches:
        for at in range(batch.num_rows):
            rows = batch.column("rows")[at].values
            yield batch, at, rows, _Pair(rows, s)


def _agreeing(s: Settings):
    """Members of each pair of blocks that have someone to be compared with; each once, however many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at, rows, pair in _pairs_of_blocks(batches, s):
            wanted = np.zeros(len(pair.node), bool)
            for i in pair.ask:
                close = pair.agreeing(i, pair.root)
                wanted[close] = True
                wanted[i] = len(close) > 0
            found = pa.array(np.flatnonzero(wanted))
            named = {c: pa.array([batch.column(c)[at].as_py()] * len(found), batch.schema.field(c).type) for c in ("key", "low", "high")}
            yield pa.record_batch({**named, **{c: rows.field(c).take(found) for c in ("asks", "node", "root", "left")}})

    return run


def _joining(idf, s: Settings):
    """Links of each pair of blocks that join two of its groups: at most as many as it has members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, rows, pair in _pairs_of_blocks(batches, s):
            words = hx.Words(rows.field("text"))
            text, shingle, weight = weighted_shingles(words, idf.value, s.words)
            names, place = np.unique(shingle, return_inverse=True)
            begin = np.searchsorted(text, np.arange(len(pair.node) + 1))
            total = np.bincount(text, weight, len(pair.node))
            own, root = np.zeros(len(names)), pair.root.copy()
            found = []
            for i in pair.ask:
                close = pair.agreeing(i, root)
                if not len(close):
                    continue
                here = place[begin[i] : begin[i + 1]]
                own[here] = weight[begin[i] : begin[i + 1]]
                counts = begin[close + 1] - begin[close]
                cells = hx.ranges(begin[close], counts)
                shared = np.minimum(own[place[cells]], weight[cells])
                common = np.add.reduceat(shared, np.cumsum(counts) - counts)
                own[here] = 0
                alike = common / (total[close] + total[i] - common)
                for j, value in zip(close[alike >= s.least], alike[alike >= s.least]):
                    if root[j] != root[i]:
                        found.append((pair.node[i], pair.node[j], value))
                        root[root == root[j]] = root[i]
            a, b, similarity = zip(*found) if found else ((), (), ())
            yield pa.record_batch({
                "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(similarity, pa.float64())
            })

    return run


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) that no path of links joins yet."""
    x = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    y = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    return pairs.join(x, "a", "left").join(y, "b", "left").filter(
        F.coalesce("ra", "a") != F.coalesce("rb", "b")
    ).select(*pairs.columns)


def _left_over(active: DataFrame, hubs: DataFrame, roots: DataFrame) -> DataFrame:
    """Members that are no hub of their bucket and not joined to one, where two or more are left."""
    named = active.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    done = hubs.select("key", F.col("hub").alias("node")).join(roots, "node", "left").select(
        "key", F.coalesce("root", "node").alias("root")
    ).distinct()
    left = named.join(done, ["key", "root"], "left_anti").select("key", "node", "rank")
    return left.join(left.groupBy("key").count().filter("count > 1").select("key"), "key", "left_semi")


def duplicate_groups(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, class_id, n_copies, kept, digest.

    ``class_id`` is the least doc_id of the group of texts that links of
    similarity 0.8 or more join, ``n_copies`` the rows with exactly this text,
    ``kept`` true for rows whose doc_id is the class_id. Nulls: a null text
    equals an empty one; rows with a null doc_id belong to groups but never
    name one while another row can, and are kept only in a group without any
    doc_id. Texts without a word are copies of each other only if equal. Rows
    that repeat a doc_id and a text are alike. Extra columns are not read; an
    empty table gives no rows.
    """
    return _rooted_groups(docs, s).drop("root")


def _rooted_groups(docs: DataFrame, s: Settings) -> DataFrame:
    """``duplicate_groups`` with the root of each group: groups of unlike texts may share a class_id."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    idf = docs.sparkSession.sparkContext.broadcast(inverse_frequencies(texts))
    signed = keep(
        texts.mapInArrow(_signer(idf, s), "doc_id long, digest binary, samples array<int>"), "signed"
    )
    nodes = keep(
        signed.groupBy("digest").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"), F.first("samples").alias("samples")
        ).withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    roots = components(links(nodes, texts, idf, s).select("a", "b"))
    rooted = nodes.select("node", "digest", "first_id", "n_copies").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    classes = rooted.join(names, "root").select("digest", "class_id", "n_copies", "root")
    return signed.select("doc_id", "digest").join(classes, "digest").select(
        "doc_id", "class_id", "n_copies",
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull()).alias("kept"), "digest", "root",
    )


def keep_first(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row of ``docs`` for each group, all columns as they are: the one with the least doc_id.

    A group without any doc_id keeps one row. Of rows that repeat a doc_id in
    one group, one stays.
    """
    chosen = _rooted_groups(docs, s).filter("kept").select("doc_id", "root", "digest")
    # the least text digest decides among several texts with the least doc_id
    one = chosen.groupBy("root").agg(F.first("doc_id").alias("id"), F.min("digest").alias("own"), F.count("*").alias("n"))
    one = lookup(one.select(F.struct("id", "own").alias("place"), "n"))
    # names that no column of docs has
    place, times = ("_" * (1 + max((len(c) for c in docs.columns), default=0)) + c for c in ("place", "n"))
    own = F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), 1, 16)
    named = docs.withColumn(place, F.struct(F.col("doc_id").cast("bigint").alias("id"), own.alias("own")))
    out = named.join(one.select(F.col("place").alias(f"{place}_"), F.col("n").alias(times)), F.col(place).eqNullSafe(F.col(f"{place}_")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # rows that repeat in the input are the only ones that move
    return out.filter(F.col(times) == 1).select(*columns).unionByName(
        out.filter(F.col(times) > 1).dropDuplicates([place]).select(*columns)
    )
