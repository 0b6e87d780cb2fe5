"""Token files: each document's ids compressed on their own with one shared dictionary.

Layout below a path:

``dictionary``  one row: ``dict_hash`` (SHA-256), ``dictionary`` (bytes, empty
                where there was too little to train on)
``blocks``      rows in ascending doc_id order over the files: ``shard`` (file
                number), ``before`` (ids in the shard ahead of the block),
                ``dict_hash``, ``width`` (bytes of an id), ``first_id`` and
                ``last_id``, and one entry per document in ``doc_ids``,
                ``counts`` (ids) and ``offsets`` (where its frame begins in
                ``data``; one more entry for the end)

A document is read by its block's bounds and its frame's offset, without
touching its neighbours. Files are written by Spark's own committer, so a lost
executor leaves no half shard, on any store that Spark can reach.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslab.llm import hashing as hx
from corpuslab.llm.encode import WordEncoder
from corpuslab.llm.store import least_hashed

SAMPLE_DOCS = 1_000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 32_768
BLOCK_DOCS = 256
TOGETHER_BYTES = 4 << 20

BLOCKS = (
    "shard int, before long, dict_hash string, width int, first_id long, last_id long, doc_ids array<long>, "
    "counts array<long>, offsets array<long>, data binary"
)


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> bytes:
    """A dictionary from the serialized ids of a bounded sample.

    The sample: the ``SAMPLE_DOCS`` texts of at most ``SAMPLE_BYTES`` bytes with
    the least hashes, each whole. Short documents gain from a dictionary, long
    ones bring their own context. Every document is compressed with it.
    """
    import zstandard

    short = docs.filter(F.octet_length("text").between(1, SAMPLE_BYTES))
    rows = least_hashed(short.select("text", F.xxhash64("doc_id", "text").alias("h")), "h", SAMPLE_DOCS)
    texts = pa.array([r.text for r in rows.select("text").collect()], pa.string())
    ids, bounds = WordEncoder(tokenizer).with_end(texts, end_id)
    raw = ids.astype(f"<u{width}").tobytes()
    samples = [raw[a * width : b * width] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:  # too few documents to learn from
        return b""


def _blocks(tokenizer: str, end_id: int, width: int, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, shard, before = WordEncoder(tokenizer), TaskContext.get().partitionId(), 0
        named = hashlib.sha256(dictionary).hexdigest()
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True)
        for batch in hx.slices(batches, "text", TOGETHER_BYTES):
            all_ids, all_bounds = encoder.with_end(batch.column("text"), end_id)
            raw = memoryview(all_ids.astype(f"<u{width}").tobytes())
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                bounds = all_bounds[at : at + part.num_rows + 1]
                frames = [
                    press.compress(raw[a * width : b * width]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                doc_ids = part.column("doc_id").to_pylist()
                there = [d for d in doc_ids if d is not None]
                yield pa.RecordBatch.from_pylist([{
                    "shard": shard, "before": before, "dict_hash": named, "width": width,
                    "first_id": min(there, default=None), "last_id": max(there, default=None), "doc_ids": doc_ids,
                    "counts": np.diff(bounds).tolist(),
                    "offsets": np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist(),
                    "data": b"".join(frames),
                }], schema=_SCHEMA)
                before += int(bounds[-1] - bounds[0])

    return run


_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("before", pa.int64()), ("dict_hash", pa.string()), ("width", pa.int32()),
    ("first_id", pa.int64()), ("last_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("counts", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("data", pa.binary()),
])


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, vocabulary: int = 49_408) -> None:
    """Write the ids of every document below ``path``.

    Null texts are empty (the end id alone); rows without a doc_id come first;
    repeated ids are written as often as they occur. An empty table gives a
    dictionary row and no block. Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    dictionary = train_dictionary(texts, tokenizer, end_id, width)
    spark.createDataFrame(
        [(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "dict_hash string, dictionary binary"
    ).write.parquet(f"{path}/dictionary")
    texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(
        _blocks(tokenizer, end_id, width, dictionary), BLOCKS
    ).write.option("compression", "none").parquet(f"{path}/blocks")


def _unpack(dictionary: bytes, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        named = hashlib.sha256(dictionary).hexdigest()
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpress = zstandard.ZstdDecompressor(dict_data=trained)
        for batch in batches:
            for row in range(batch.num_rows):
                block = {n: batch.column(n)[row] for n in batch.schema.names}
                if block["dict_hash"].as_py() != named:
                    raise ValueError("block was written with another dictionary")
                counts, data = np.asarray(block["counts"].values), memoryview(block["data"].as_buffer())
                offsets, kind = block["offsets"].as_py(), f"<u{block['width'].as_py()}"
                ids = [
                    np.frombuffer(unpress.decompress(data[a:b]), kind).astype("<u4")
                    for a, b in zip(offsets[:-1], offsets[1:], strict=True)
                ]
                if [len(x) for x in ids] != counts.tolist():
                    raise ValueError("a document's length differs from its index entry")
                begin = block["before"].as_py() + np.cumsum(counts) - counts
                last = pa.array([zlib.crc32(x) for x in ids], pa.int64()) if digest else pa.array(
                    [x.astype(np.int64) for x in ids], pa.list_(pa.int64())
                )
                yield pa.record_batch([
                    pa.array([block["shard"].as_py()] * len(ids), pa.int32()), block["doc_ids"].values,
                    pa.array(begin, pa.int64()), pa.array(counts, pa.int64()), last,
                ], names=["shard", "doc_id", "in_shard", "n_tokens", "ids_crc32" if digest else "ids"])

    return run


def _dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(row.dictionary).hexdigest() != row.dict_hash:
        raise ValueError("the dictionary does not have the hash that the files name")
    return bytes(row.dictionary)


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; with ``digest`` ids_crc32 in place of the ids."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    sizes = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    # one row per file
    shards = blocks.groupBy("shard").agg(F.sum(sizes).alias("n")).select(
        "shard",
        (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("ahead"),
    )
    last = "ids_crc32 long" if digest else "ids array<long>"
    each = blocks.mapInArrow(
        _unpack(_dictionary(spark, path), digest), f"shard int, doc_id long, in_shard long, n_tokens long, {last}"
    )
    return each.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("ahead") + F.col("in_shard")).alias("start"), "n_tokens", last.split()[0]
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int]:
    """Ids of one document: only blocks whose bounds hold the id are opened, only its frame is decompressed."""
    import zstandard

    near = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").filter(
        (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)
    ).withColumn("at", F.array_position("doc_ids", F.lit(doc_id).cast("bigint"))).filter("at > 0")
    row = near.select("width", F.expr("substring(data, 1 + get(offsets, int(at) - 1), "
                                      "get(offsets, int(at)) - get(offsets, int(at) - 1))").alias("frame")).first()
    if row is None:
        raise KeyError(doc_id)
    dictionary = _dictionary(spark, path)
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    raw = zstandard.ZstdDecompressor(dict_data=trained).decompress(bytes(row.frame))
    return np.frombuffer(raw, f"<u{row.width}").tolist()
