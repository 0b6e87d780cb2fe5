"""Quality counts against plain Python, and the edge cases."""

import re

from corpuslab.llm import quality

WORD = r"[^\x20\x09-\x0D]+"


def counts(text):
    words = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(p for i in at for p in (i, i + 1, i + 2))
    return (
        len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a a", "x y z x y z x y\nx y z",
    "dup\ndup\n dup\n\n\ndup", "# a $ b <c> 𝔘𝔫𝔦 é\x0bü\x0cö", "the same the same the same 1 2 3 the same the",
    "w " * 300, " ".join(f"w{i}" for i in range(200)),
]


def test_counts(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a b", None)],
                                 "doc_id long, text string, n_words string")
    rows = quality.judge(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        if r.doc_id is not None:
            q = r.q
            assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == counts(TEXTS[r.doc_id])
            assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words)
            assert not (q.base_failed and q.kept)


def test_filter_keeps_columns(spark):
    good = " ".join(f"the word{i} of" for i in range(40))
    docs = spark.createDataFrame([(1, good, "x", 7), (2, "short", "y", 8), (1, good, "x", 7)],
                                 "doc_id long, text string, n_words string, q int")
    out = quality.keep_good(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    assert [(r.doc_id, r.q) for r in out.collect()] == [(1, 7), (1, 7)]


def test_filter_stays_above_the_steps(spark):
    docs = spark.createDataFrame([(1, " ".join(f"the w{i}" for i in range(40_000)))], "doc_id long, text string")
    assert quality.keep_good(docs).count() == 1  # takes minutes if words are split again for every word


def test_empty_table_and_no_python(spark):
    out = quality.judge(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
