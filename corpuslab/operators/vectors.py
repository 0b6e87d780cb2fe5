"""Word vectors to document vectors, and column statistics of vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.operators.postings import is_bagged
from corpuslab.operators.unnest import each_at
from corpuslab.operators.weights import postings
from corpuslab.session import cut_lineage, lookup, measured

# Measured bytes of word vectors that are broadcast; a driver holds such a table several times over.
WHOLE_BYTES = 32 << 20
# Words of documents that meet their vectors in one task, beyond that.
GROUP_ROWS = 1 << 20
# Numbers that are added up at once.
CELLS = 1 << 22


def vector_width(vectors: DataFrame, vector: str = "vector") -> int:
    """Width of the vectors, read from one row."""
    first = vectors.select(F.size(vector)).first()
    return 0 if first is None else int(first[0])


def _sums(vector: str, weight: Column, dim: int) -> list[Column]:
    # get() by position keeps each dimension a plain codegen sum, so a task
    # adds vectors into one buffer per group instead of emitting dim rows.
    return [F.sum(F.get(F.col(vector), F.lit(i)) * weight).alias(f"_s{i}") for i in range(dim)]


def _packed(dim: int, scale: Column) -> Column:
    return F.array(*[F.coalesce(F.col(f"_s{i}") / scale, F.lit(0.0)) for i in range(dim)])


def word_vector_lookup(
    rows: DataFrame, vectors: DataFrame, key: str = "doc_id", words: str = "words"
) -> DataFrame:
    """(key, word, n, + vector columns) for the words that have a vector."""
    return postings(rows, key, words).join(lookup(vectors), "word")


def vector_and_weight_lookup(
    rows: DataFrame, vectors: DataFrame, idf: DataFrame, key: str = "doc_id", words: str = "words"
) -> DataFrame:
    """As above for words that have both a vector and an idf."""
    both = vectors.join(idf.select("word", "idf"), "word")
    return postings(rows, key, words).join(lookup(both), "word")


def _document_vectors(
    rows: DataFrame, table: DataFrame, weight: Column, key: str, words: str, dim: int
) -> DataFrame:
    if is_bagged(rows):
        counted = rows.select(key, F.inline_outer("bag"))
    else:
        counted = (
            rows.select(key, F.explode_outer(words).alias("word"))
            .groupBy(key, "word")
            .agg(F.count("word").alias("n"))
        )
    table, size = measured(table)
    if size > WHOLE_BYTES:
        # bags are stored; words of texts are not, and are read three times
        counted = counted if is_bagged(rows) else cut_lineage(counted)
        return _sent_vectors(counted, table.withColumn("_weight", weight).drop("idf"), key, dim)
    joined = counted.join(F.broadcast(table), "word", "left")
    known = F.sum(F.when(F.col("vector").isNotNull(), F.col("n")).otherwise(F.lit(0)))
    sums = joined.groupBy(key).agg(
        known.alias("known"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        *_sums("vector", F.col("n") * weight, dim),
    )
    scale = F.nullif(F.col("known"), F.lit(0).cast("bigint"))
    return sums.select(key, "known", "total", _packed(dim, scale).alias("vector"))


def meet(rows: DataFrame, table: DataFrame, key: str, on: str, add, schema: str) -> DataFrame:
    """``add(rows, table)`` for groups of whole keys of ``rows`` (read three times), each with those rows of ``table`` that it asks for by ``on``."""
    groups = max(1, -(-rows.count() // GROUP_ROWS))
    left = rows.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups)))
    # under names of its own: both sides stem from one table
    wanted = left.select(F.col("_group").alias("_to"), F.col(on).alias(on)).distinct()
    sent = wanted.join(table, on)
    # by number: small partitions are not put together again, so a task holds few groups
    left, sent = left.repartition(groups, "_group"), sent.repartition(groups, "_to")
    return left.groupBy("_group").cogroup(sent.groupBy("_to")).applyInArrow(add, schema)


def _sent_vectors(counted: DataFrame, table: DataFrame, key: str, dim: int) -> DataFrame:
    """As ``_document_vectors`` for a table of any size: vectors go to the groups of documents that hold their words.

    A group has about ``GROUP_ROWS`` words and gets the vector of each of its
    distinct words once, so neither the driver nor a task holds the whole
    table, and the sum of a document is made in one place.
    """
    counted = counted.select(key, "word", "n")
    kind = counted.schema[key].dataType.simpleString()
    # a missing number adds nothing, as in a sum of the joined rows
    full = F.array(*[F.coalesce(F.get("vector", F.lit(i)) * F.col("_weight"), F.lit(0.0)) for i in range(dim)])
    table = table.select("word", F.col("vector").isNotNull().cast("bigint").alias("has"), full.alias("vector"))

    def add(rows: pa.Table, found: pa.Table) -> pa.Table:
        coded = rows.column(key).combine_chunks().dictionary_encode(null_encoding="encode")
        doc, size = np.asarray(coded.indices, np.int64), len(coded.dictionary)
        n = np.asarray(pc.fill_null(rows.column("n"), 0), np.int64)
        # a word that stands in the table more than once counts as often
        named = found.column("word").combine_chunks().dictionary_encode()
        code, words = np.asarray(named.indices, np.int64), named.dictionary
        held, has = np.zeros((len(words), dim)), np.zeros(len(words), np.int64)
        flat = np.asarray(found.column("vector").combine_chunks().flatten(), np.float64)
        np.add.at(held, code, flat.reshape(-1, dim))
        np.add.at(has, code, np.asarray(found.column("has"), np.int64))
        times = np.bincount(code, minlength=len(words))
        at = np.asarray(pc.fill_null(pc.index_in(rows.column("word"), words, skip_nulls=True), -1), np.int64)
        hit = np.nonzero(at >= 0)[0]
        often = np.ones(len(n), np.int64)
        often[hit] = times[at[hit]]
        total, known, sums = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros((size, dim))
        np.add.at(total, doc, n * often)
        np.add.at(known, doc[hit], n[hit] * has[at[hit]])
        hit = hit[np.argsort(doc[hit], kind="stable")]
        step = max(1, CELLS // dim)
        for start in range(0, len(hit), step):
            part = hit[start : start + step]
            first = np.nonzero(np.append(True, doc[part][1:] != doc[part][:-1]))[0]
            sums[doc[part][first]] += np.add.reduceat(held[at[part]] * n[part][:, None], first)
        means = sums / np.maximum(known, 1)[:, None]
        packed = pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * dim, pa.int32()), pa.array(means.ravel()))
        return pa.table({key: coded.dictionary, "known": known, "total": total, "vector": packed})

    return meet(counted, table, key, "word", add, f"{key} {kind}, known bigint, total bigint, vector array<double>")


def mean_word_vectors(
    rows: DataFrame, vectors: DataFrame, dim: int, key: str = "doc_id", words: str = "words"
) -> DataFrame:
    """(key, known, total, vector): sum of known word vectors over their number.

    Every row of ``rows`` is kept; without a known word the vector is zero.
    Words are counted per document before the join, so a word repeated in a
    document meets the vector table once.
    """
    return _document_vectors(rows, vectors.select("word", "vector"), F.lit(1.0), key, words, dim)


def weighted_word_vectors(
    rows: DataFrame,
    vectors: DataFrame,
    idf: DataFrame,
    dim: int,
    key: str = "doc_id",
    words: str = "words",
) -> DataFrame:
    """Sum of vector times idf over the number of words that have both."""
    both = vectors.select("word", "vector").join(idf.select("word", "idf"), "word")
    return _document_vectors(rows, both, F.col("idf"), key, words, dim)


def mean_vector_by(
    df: DataFrame, group: str | Sequence[str], dim: int, vector: str = "vector"
) -> DataFrame:
    """Element-wise mean per group; a large group is summed inside each task first."""
    keys = [group] if isinstance(group, str) else list(group)
    sums = df.groupBy(*keys).agg(F.count("*").alias("n"), *_sums(vector, F.lit(1.0), dim))
    return sums.select(*keys, "n", _packed(dim, F.col("n")).alias("vector"))


def standardize(
    df: DataFrame,
    dim: int,
    vector: str = "vector",
    train: Column | None = None,
    per_split: str | None = None,
) -> DataFrame:
    """Zero mean and unit population deviation per dimension.

    ``train`` selects the rows whose statistics are used for all rows;
    ``per_split`` uses each split's own statistics instead. A dimension without
    spread becomes zero. The rows are read for the statistics and again for
    the result, so they are written once.
    """
    df = cut_lineage(df)
    entry = [F.get(F.col(vector), F.lit(i)) for i in range(dim)]
    moments = [
        F.array(*[F.avg(e) for e in entry]).alias("_mean"),
        F.array(*[F.stddev_pop(e) for e in entry]).alias("_dev"),
    ]
    if per_split is None:
        basis = df if train is None else df.filter(train)
        stats = basis.agg(F.struct(*moments)).scalar()
        placed = df.withColumn("_stats", stats).withColumns(
            {"_mean": F.col("_stats._mean"), "_dev": F.col("_stats._dev")}
        )
    else:
        placed = df.join(lookup(df.groupBy(per_split).agg(*moments)), per_split)
    scaled = F.zip_with(
        F.zip_with(F.col(vector), F.col("_mean"), lambda x, m: x - m),
        F.col("_dev"),
        lambda c, s: F.when(s > 0, c / s).otherwise(F.lit(0.0)),
    )
    return placed.withColumn(vector, scaled).drop("_stats", "_mean", "_dev")


def explode_vector(df: DataFrame, *keys: str, vector: str = "vector", digits: int = 6) -> DataFrame:
    """One row per dimension, rounded; the shape used for checks and exports."""
    return each_at(df, vector, "dim", "value", *keys).withColumn("value", F.round("value", digits))
