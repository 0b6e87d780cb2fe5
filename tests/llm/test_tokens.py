"""Encoder, token files and packing against the tokenizer itself and exact round trips."""

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpuslab.llm import packing, store, tokenfiles
from corpuslab.llm.encode import WordEncoder
from corpuslab.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\x0b\x0c", "a", "It's  the DOG's, 'S it'll", "É e\u0301 \u0301x a\u0301b", "ÀÉ\u00a0x\u2003y\u3000z",
    "12 345 6.7...!?", "汉字 かな 𝔘𝔫𝔦 😀😀 x", "ΑΣ Σ ΣΑΣ\u2028q", "a\x00b \ufeffc", "word " * 3000, "<|endoftext|> x <|startoftext|>",
    "İstanbul ﬁ ſ ǅ", "e\u0301" * 50, "x" * 5000,
]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def split(ids, counts):
    ends = list(accumulate(counts))
    return [ids[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)]


def test_encoder_equals_tokenizer(spark, plain):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    encoder = WordEncoder(tokenizer_path())
    for _ in range(2):  # the second time from memory
        ids, counts = encoder.encode(pa.array(texts, pa.string()))
        assert split(ids, counts) == [plain(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_encoder_on_any_text(plain, texts):
    ids, counts = _ENCODER.encode(pa.array(texts, pa.string()))
    assert split(ids, counts) == [plain(t) for t in texts]


_ENCODER = WordEncoder(tokenizer_path())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("width", [49_408, 100_000])
def test_token_files_round_trip(spark, plain, width):
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(None, "no id"), (6, "again"), (6, "again")]
    rows += [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, start int").repartition(4)
    path = store.new_path(spark, "test")
    tokenfiles.write(docs, path, tokenizer_path(), 1, width)
    got = tokenfiles.read(spark, path).orderBy("start").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [(r.doc_id, r.ids) for r in got] == [(d, plain(t) + [1]) for d, t in want]
    starts = [0, *accumulate(len(r.ids) for r in got)]
    assert [r.start for r in got] == starts[:-1] and [r.n_tokens for r in got] == [len(r.ids) for r in got]
    digests = tokenfiles.read(spark, path, digest=True).orderBy("start").collect()
    assert [r.ids_crc32 for r in digests] == [crc(r.ids) for r in got]
    assert tokenfiles.read_document(spark, path, 9) == plain(ODD[3]) + [1]
    assert tokenfiles.read_document(spark, path, 1005) == next(r.ids for r in got if r.doc_id == 1005)
    with pytest.raises(KeyError):
        tokenfiles.read_document(spark, path, 10)


def test_token_files_of_an_empty_table(spark):
    path = store.new_path(spark, "test")
    tokenfiles.write(spark.createDataFrame([], "doc_id long, text string"), path, tokenizer_path(), 1)
    assert tokenfiles.read(spark, path).count() == 0


def test_pieces(spark, plain):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(None, "q", 1)],
                                 "doc_id long, text string, piece int")
    got = packing.pieces(docs, tokenizer_path(), 0, 64).collect()
    want = []
    for i, t in [*enumerate(ODD), (None, "q")]:
        ids = plain(t) + [0]
        for p, a in enumerate(range(0, len(ids), 64)):
            part = ids[a : a + 64]
            want.append((i, p, a, len(part), crc(part)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_meets_the_bound(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pieces(docs, tokenizer_path()).cache()
    bound = packing.global_bound(pieces)
    for rows, more in ((50_000, 1), (40, 3)):
        out = packing.pack(pieces, partition_rows=rows).collect()
        assert len(out) == pieces.count()
        assert check_packing(out, 2048) <= bound + more


@pytest.mark.parametrize("lengths,least", [
    ([10] * 7, 7), ([6, 4] * 5, 5), ([5, 5, 5], 2), ([1], 1), ([7, 7, 3, 3, 2, 8], 3), ([4, 4, 4, 6, 6, 6, 2, 2, 2], 4),
])
def test_bound_and_best_fit(lengths, least):
    got = np.array(sorted(lengths, reverse=True))
    where, at, room = packing.best_fit(got, 10)
    assert packing.lower_bound(got, 10) <= least <= len(room)
    assert (np.bincount(where, got) + room == 10).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_bound_never_exceeds_a_packing(lengths):
    got = np.array(sorted(lengths, reverse=True))
    where, at, room = packing.best_fit(got, 30)
    assert packing.lower_bound(got, 30) <= len(room)
    assert (room >= 0).all()


def test_rounds_keep_every_row(spark):
    rows = [(i, (i * 37) % 29 + 1) for i in range(3000)] + [(7, 8), (7, 8)]
    items = spark.createDataFrame(rows, "part_id long, length long").repartition(5)
    out = packing.pack(items, 30, partition_rows=200).collect()
    assert sorted((r.part_id, r.length) for r in out) == sorted(rows)
    used = check_packing(out, 30)
    assert used <= packing.global_bound(items, 30) * 1.03
    empty = packing.pack(spark.createDataFrame([], "length long"))
    assert empty.count() == 0
