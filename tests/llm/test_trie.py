"""The trie against one built turn by turn in plain Python, collisions, and pieces of every step."""

import hashlib
import itertools
import re
import zlib

import pytest

from corpuslab.llm import trie

COLUMNS = "conv_id long, turn long, role string, text string, depth string, ref int"


def by_hand(rows):
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            held.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    held = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in held.items()}
    rebuilt = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = held.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + own[h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        under = [(p, m) for p, m in nodes.items() if p[: len(path)] == path]
        inner = {p[:-1] for p in nodes if p}
        ends = sorted(c for c in members if len(rebuilt[c]) == len(path))
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
            sum(1 for p in nodes if p and p[:-1] == path), sum(1 for p, _ in under if p not in inner),
            sum((len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p, m in under if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def conversations():
    rows = []
    for c in itertools.chain(range(0, 130), [400, 401, 403, 419, 555, -20, -3, -25]):
        for t in range((c * 7) % 6 + (1 if c % 3 else 2)):
            # few texts and roles, so that conversations share beginnings and some are copies
            rows.append((c, t if t else None, ["user", None, "assistant"][(c // 40 + t) % 3], f"hello {t} w{c % 2 * t}"))
    rows += [(7, 0, "user", "tie b"), (7, 0, "user", "tie a"), (7, 0, "user", "tie a"), (None, 1, "user", "nobody")]
    rows += [(2000, t, "user", f"long {t % 5}\n x") for t in range(700)]  # one long conversation
    rows += [(c, t, "user", "same words here") for c in range(3000, 3400) for t in range(4)]  # one group of copies
    rows += [(640, 0, None, None), (640, 1, None, ""), (641, 0, "", "long " * 40_000)]
    return rows


def rows_of(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS)


@pytest.fixture
def many_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHAIN_PIECE", 64)
    monkeypatch.setattr(trie, "ENDS_PIECE", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_as_built_turn_by_turn(spark, many_pieces):
    rows = conversations()
    assert rows_of(trie.trie(table(spark, rows))) == by_hand(rows)


def test_collisions_are_seen_and_mended(spark):
    rows = [r for r in conversations() if r[0] != 2000]
    rows += [(c, t, "user", f"turn {c} {t}") for c in range(5000, 5600) for t in range(2)]
    got = trie.trie(table(spark, rows), [(5, 7, 5), trie.PRIMES])
    assert rows_of(got) == by_hand(rows)
    with pytest.raises(RuntimeError):
        trie.trie(table(spark, rows), [(5, 7, 5)])


def test_powers(spark):
    lane = trie.Lane(1, trie.PRIMES[1], 0)
    places = [0, 1, 63, 64, 4095, 4096, 10**6 + 7, (1 << 33) - 1]
    df = spark.createDataFrame([(n,) for n in places], "n long").select("n", lane.power(trie.F.col("n")).alias("p"))
    assert {r.n: r.p for r in df.collect()} == {n: pow(lane.base, n, lane.prime) for n in places}


def test_empty_and_turnless(spark):
    assert trie.trie(table(spark, [])).count() == 0
    short = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, 0, "user", "x") for c in short]  # the base is absent and the only turn is left out
    assert rows_of(trie.trie(table(spark, rows))) == by_hand(rows)
