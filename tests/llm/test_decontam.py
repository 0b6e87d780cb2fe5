"""Benchmark overlaps against a comparison along every diagonal."""

import itertools
import random
import re

import numpy as np

from corpuslab.llm import decontam

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_force(text, item, how=decontam.Overlap()):
    covered = set()
    for lies in range(-len(item), len(text)):
        low, high = max(0, -lies), min(len(item), len(text) - lies)
        same = np.array([item[i] == text[lies + i] for i in range(low, high)], bool)
        if same.sum() >= 5:
            a, b = decontam._best_stretch(same)
            equal = same[a:b].sum()
            if equal >= min(how.short, how.part * len(item)) and equal >= how.share * (b - a):
                covered |= {low + a + i for i in np.flatnonzero(same[a:b])}
    return len(covered) if len(covered) >= min(how.words, how.part * len(item)) else 0


def test_masks_find_every_overlap_with_two_replaced_words():
    ones = [[i for i, c in enumerate(m) if c == "1"] for m in decontam.MASKS]
    for bad in itertools.combinations(range(14), 2):
        assert any(not {p + i for i in m} & set(bad) for m in ones for p in range(14 - m[-1]))


def test_best_stretch():
    t, f = True, False
    assert decontam._best_stretch(np.array([t, t, f, t, t, t])) == (0, 6)
    assert decontam._best_stretch(np.array([t, f, f, f, t, t])) == (4, 6)
    assert decontam._best_stretch(np.array([f, f])) == (0, 0) or decontam._best_stretch(np.array([f, f]))[0] == 0


def test_replaced_words_nulls_ties_and_repeats(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [rng.sample(vocabulary, n) for n in (40, 25, 20, 16, 14)]
    rows, want = [], set()
    for doc in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if doc % 2:
            no = rng.randrange(len(items))
            passage = list(items[no])
            for at in rng.sample(range(len(passage)), len(passage) // 8):
                passage[at] = "other"
            text[rng.randint(0, len(text)) : 0] = passage
            want.add((doc, no))
        rows.append((doc, " ".join(text).upper() if doc % 5 == 0 else ", ".join(text)))
    rows += [(1000, None), (1001, ""), (1002, " ".join(items[0])), (1002, " ".join(items[0])), (None, " ".join(items[1])),
             (1003, "lead " + " ".join(items[0][:13]))]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame(
        [(i, " ".join(x)) for i, x in enumerate(items)] + [(90, None), (91, ""), (92, "... !")], "item_id long, text string"
    )
    got = [(r.doc_id, r.item_id) for r in decontam.overlaps(docs, bench).collect()]
    assert got.count((1002, 0)) == 2 and (None, 1) in got and (1003, 0) in got
    assert want <= set(got)
    brute = {(d, i) for d, t in rows for i, x in enumerate(items) if brute_force(words(t), x)}
    assert {g for g in got if g[0] not in (None,)} == {b for b in brute if b[0] is not None}
    blocks = [(r.doc_id, r.item_id) for r in decontam.overlaps(docs, bench, block_bytes=100).collect()]
    assert sorted(blocks, key=repr) == sorted(got, key=repr)
    clean = decontam.drop_contaminated(docs, bench, block_bytes=150)
    assert clean.columns == docs.columns
    bad = {g[0] for g in got}
    assert sorted((r.doc_id for r in clean.collect())) == sorted(r[0] for r in rows if r[0] not in bad)


def test_test_table(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: words(r.text) for r in bench.collect()}
    want = {}
    for r in docs.collect():
        text = words(r.text)
        for i, x in items.items():
            if set(zip(text, text[1:], strict=False)) & set(zip(x, x[1:], strict=False)):
                n = brute_force(text, x)
                if n:
                    want[r.doc_id, i] = n
    got = {(r.doc_id, r.item_id): r.n_matched for r in decontam.overlaps(docs, bench).collect()}
    assert got == want and got


def by_the_rule(text, item, how=decontam.Overlap()):
    """Covered words of the item over all stretches of all diagonals."""
    covered = set()
    for lies in range(-len(item), len(text)):
        at = range(max(0, -lies), min(len(item), len(text) - lies))
        equal = [i for i in at if item[i] == text[lies + i]]
        for a, b in itertools.combinations_with_replacement(range(len(equal)), 2):
            n = b - a + 1
            if n >= min(how.short, how.part * len(item)) and n >= how.share * (equal[b] - equal[a] + 1):
                covered |= set(equal[a : b + 1])
    return len(covered) if covered and len(covered) >= min(how.words, how.part * len(item)) else 0


def test_every_accepted_pattern_has_a_mask():
    fits = [[i for i, c in enumerate(m) if c == "1"] for m in decontam.MASKS]
    for size in range(6, 17):
        for n in range(max(6, -(-7 * size // 10)), size + 1):
            for inner in itertools.combinations(range(1, size - 1), n - 2):
                ones = {0, size - 1, *inner}
                assert any({p + i for i in m} <= ones for m in fits for p in range(size - m[-1]))


def test_short_items_heavy_edits_and_split_items(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [rng.sample(vocabulary, n) for n in [*range(1, 18), 24, 40]]
    texts = []
    for item in items * 6:
        passage = list(item)
        for at in rng.sample(range(len(passage)), rng.randint(0, len(passage) * 3 // 10)):
            passage[at] = "other"
        texts.append(rng.sample(vocabulary, 10) + passage + rng.sample(vocabulary, 10))
    # the middle was replaced by as many words: two stretches on one diagonal
    texts.append([*items[-1][:8], *["x"] * 24, *items[-1][32:]])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_matched for r in decontam.overlaps(docs, bench).collect()}
    want = {(d, i): n for d, t in enumerate(texts) for i, x in enumerate(items) if (n := by_the_rule(t, x))}
    assert got == want and {i for _, i in got} == set(range(len(items))) and got[len(texts) - 1, len(items) - 1] == 16


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert decontam.overlaps(docs, bench).count() == 0 and decontam.overlaps(full, bench).count() == 0
    assert decontam.drop_contaminated(full, bench).count() == 1
