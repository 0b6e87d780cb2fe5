"""The prefix trie of rebuilt conversations, from fingerprints that compose.

A conversation is rebuilt from the first turns of its base and its own turns
after as many. The fingerprint of a sequence of turns is a polynomial in the
turns' hashes (three lanes, each modulo a prime), an element of a monoid: that
of two sequences in a row is found from theirs and their lengths alone. So the
prefixes of a rebuilt conversation have fingerprints made of the base's head
and the conversation's own running products; its texts are never put together,
and a turn of it is a reference to the stored turn. Running products are taken
inside the pieces of the stored order first and joined by piece, so that a
conversation of any length is no single task's work.

Equal fingerprints make a node. Every node is then checked: all its members
must come from one parent node and their last turns, read through the stored
references, must be equal texts; by induction its members are equal sequences.
If any node fails, everything is taken again with other bases.

A conversation belongs to the nodes of its prefixes only, and the smallest
member of a node stays the smallest further down. Sums over the subtree of a
node are therefore sums over its members of what their own chains of nodes
hold, less what the smallest member's chain holds above the node: no walk over
levels, however deep the trie is.

Defined results: null roles and texts are empty; turns of one conversation are
ordered by turn (null first), then role, then text, so repeated rows are turns
in a row; rows without a conversation id belong to no conversation; a missing
base has no turns. Remainders are truncated towards zero, as in SQL. An empty
table has no conversations, hence no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuslab.llm.store import keep

MOST_HEAD = 3  # turns that a base gives at most
FAMILY = 20  # conversations that share a base
PRIMES = (2147483647, 2147483629, 2147483587)
LANES = range(len(PRIMES))
# Turns of one piece of a chain, when what a chain holds above a node is added up.
CHAIN_PIECE = 1 << 16
# Ids joined at once for the digest of a node's ends.
ENDS_PIECE = 512
KEY = ["depth", *[f"f{j}" for j in LANES]]
PARENT = [f"p{j}" for j in LANES]
_POSITION_BITS = 33  # of monotonically_increasing_id
_DIGIT_BITS = 6
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def head_length(conv_id: Column) -> Column:
    """Turns that the base gives to a conversation."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (MOST_HEAD + 1)).cast("int")


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % FAMILY


class Lane:
    """One lane of the fingerprint: arithmetic modulo ``prime``, below 2**31, so that no product overflows."""

    def __init__(self, number: int, prime: int, attempt: int):
        drawn = hashlib.sha256(f"{number} {attempt}".encode()).digest()
        self.prime = prime
        self.base = 2 + int.from_bytes(drawn[:8], "big") % (prime - 3)
        self.salt = int.from_bytes(drawn[8:14], "big")

    def turn(self) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.salt), "role", "text"), F.lit(self.prime))

    def times(self, a: Column, b: Column) -> Column:
        return a * b % self.prime

    def minus(self, a: Column, b: Column) -> Column:
        return F.pmod(a - b, F.lit(self.prime))

    def power(self, n: Column) -> Column:
        """base ** n, digit by digit from tables of the digits' powers."""
        out, step, size = None, self.base, 1 << _DIGIT_BITS
        for k in range(_POSITION_BITS // _DIGIT_BITS + 1):
            listed = ", ".join(f"{pow(step, i, self.prime)}L" for i in range(size))
            digit = F.shiftright(n.cast("bigint"), k * _DIGIT_BITS).bitwiseAND(F.lit(size - 1))
            found = F.get(F.expr(f"array({listed})"), digit.cast("int"))
            out = found if out is None else self.times(out, found)
            step = pow(step, size, self.prime)
        return out

    def shift_back(self, n: Column) -> Column:
        """base ** -n for n of 0 to the longest head."""
        listed = ", ".join(f"{pow(self.base, -i, self.prime)}L" for i in range(MOST_HEAD + 1))
        return F.get(F.expr(f"array({listed})"), n)


def stored_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, ref, role, text, n_words): turns in the order of their conversations; ``ref`` rises with it.

    The order is by ranges, so a conversation of any length spreads over tasks.
    """
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # the ranges are cut by short keys; whole texts decide ties inside a range
    placed = turns.repartitionByRange("conv_id", "turn", F.left("role", F.lit(16)), F.left("text", F.lit(32)))
    ordered = placed.sortWithinPartitions("conv_id", "turn", "role", "text")
    return keep(
        ordered.select(
            "conv_id", F.monotonically_increasing_id().alias("ref"), "role", "text",
            F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint").alias("n_words"),
        ),
        "turns",
    )


def running_products(turns: DataFrame, lanes: list[Lane]) -> DataFrame:
    """(conv_id, ref, pos, n_words, r<j>, t<j>): place of every turn from 1, product of all turns up to it, own term."""
    hashed = turns.select(
        "conv_id", "ref", "n_words", F.shiftright("ref", _POSITION_BITS).alias("piece"),
        *[lane.turn().alias(f"x{j}") for j, lane in enumerate(lanes)],
    )
    # a piece is what one task of the ordered table wrote of one conversation
    inside = W.partitionBy("conv_id", "piece").orderBy("ref")
    ranked = hashed.withColumn("at", F.row_number().over(inside))
    ranked = ranked.select(
        "conv_id", "ref", "n_words", "piece", "at",
        *[lane.times(F.col(f"x{j}"), lane.power(F.col("at"))).alias(f"l{j}") for j, lane in enumerate(lanes)],
    )
    up_to = inside.rowsBetween(W.unboundedPreceding, 0)
    ranked = keep(
        ranked.select("*", *[(F.sum(f"l{j}").over(up_to) % lane.prime).alias(f"s{j}") for j, lane in enumerate(lanes)]),
        "ranked",
    )
    whole = ranked.groupBy("conv_id", "piece").agg(
        F.max("at").alias("n"), *[F.max_by(f"s{j}", "at").alias(f"s{j}") for j in LANES]
    )
    # a conversation has at most as many pieces as the table has partitions
    before = W.partitionBy("conv_id").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    whole = whole.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)))
    shift = [lane.power(F.col("skip")).alias(f"b{j}") for j, lane in enumerate(lanes)]
    whole = whole.select("conv_id", "piece", "skip", *[f"s{j}" for j in LANES], *shift)
    joined = [
        (F.coalesce(F.sum(lane.times(F.col(f"s{j}"), F.col(f"b{j}"))).over(before), F.lit(0)) % lane.prime).alias(f"c{j}")
        for j, lane in enumerate(lanes)
    ]
    whole = whole.select("conv_id", "piece", "skip", *[f"b{j}" for j in LANES], *joined)
    return keep(
        ranked.join(whole, ["conv_id", "piece"]).select(
            "conv_id", "ref", "n_words", (F.col("skip") + F.col("at")).alias("pos"),
            *[((F.col(f"c{j}") + lane.times(F.col(f"s{j}"), F.col(f"b{j}"))) % lane.prime).alias(f"r{j}")
              for j, lane in enumerate(lanes)],
            *[lane.times(F.col(f"l{j}"), F.col(f"b{j}")).alias(f"t{j}") for j, lane in enumerate(lanes)],
        ),
        "products",
    )


def plans(products: DataFrame) -> DataFrame:
    """One row for each conversation: how long its head is, what the base's head holds, what it leaves out of its own."""

    def at(i: int, column: str) -> Column:
        return F.max(F.when(F.col("pos") == i, F.col(column)))

    def heads(column: str) -> Column:
        return F.array(*[at(i, column) for i in range(1, MOST_HEAD + 1)]).alias(column)

    own = keep(
        products.groupBy("conv_id").agg(
            F.max("pos").alias("turns"), heads("ref"), heads("n_words"),
            *[F.array(F.lit(0).cast("bigint"), *[at(i, f"r{j}") for i in range(1, MOST_HEAD + 1)]).alias(f"r{j}")
              for j in LANES],
        ),
        "heads",
    )
    names = ["turns", "ref", "n_words", *[f"r{j}" for j in LANES]]
    base = own.select(F.col("conv_id").alias("base_id"), *[F.col(n).alias(f"base_{n}") for n in names])
    asked = own.select(
        "conv_id", "turns", base_of(F.col("conv_id")).alias("base_id"), head_length(F.col("conv_id")).alias("h"),
        *[F.get(f"r{j}", head_length(F.col("conv_id"))).alias(f"left{j}") for j in LANES],
    )
    joined = asked.join(base, "base_id", "left")
    k = F.least("h", F.coalesce("base_turns", F.lit(0))).cast("int")
    return joined.select(
        "conv_id", "h", k.alias("k"), (F.col("h") - k).alias("missing"),
        (k + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("length"),
        *[f"left{j}" for j in LANES], *[f"base_{n}" for n in names if n != "turns"],
    )


def rebuilt_prefixes(products: DataFrame, rebuilt: DataFrame, lanes: list[Lane]) -> DataFrame:
    """One row for each prefix of each rebuilt conversation, from the empty one on.

    (conv_id, depth, f<j>, p<j>, ref, n_words, ends): fingerprint, that of the
    prefix before, the stored turn that is last, its words, and whether the
    conversation ends here.
    """
    zero = F.lit(0).cast("bigint")

    def columns(depth, prints, parents, ref, words) -> list[Column]:
        return [
            F.col("conv_id"), depth.cast("bigint").alias("depth"),
            *[p.alias(f"f{j}") for j, p in enumerate(prints)], *[p.alias(f"p{j}") for j, p in enumerate(parents)],
            ref.alias("ref"), words.alias("n_words"), (F.col("length") == depth).alias("ends"),
        ]

    none = F.lit(None).cast("bigint")
    roots = rebuilt.select(*columns(F.lit(0), [zero for _ in LANES], [none for _ in LANES], none, zero))
    at = F.col("at")
    heads = rebuilt.filter("k > 0").withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k")))).select(
        *columns(
            at, [F.get(f"base_r{j}", at) for j in LANES], [F.get(f"base_r{j}", at - 1) for j in LANES],
            F.get("base_ref", at - 1), F.get("base_n_words", at - 1),
        )
    )
    own = products.join(
        rebuilt.select(
            "conv_id", "h", "k", "missing", "length", *[f"left{j}" for j in LANES],
            *[F.coalesce(F.get(f"base_r{j}", F.col("k")), zero).alias(f"head{j}") for j in LANES],
        ),
        "conv_id",
    ).filter("pos > h")

    def composed(j: int, lane: Lane, up_to: Column) -> Column:
        """The base's head, then the own turns after the first h up to a place, moved to where the head ends."""
        suffix = lane.times(lane.minus(up_to, F.col(f"left{j}")), lane.shift_back(F.col("missing")))
        return (F.col(f"head{j}") + suffix) % lane.prime

    tails = own.select(
        *columns(
            F.col("pos") - F.col("missing"),
            [composed(j, lane, F.col(f"r{j}")) for j, lane in enumerate(lanes)],
            [composed(j, lane, lane.minus(F.col(f"r{j}"), F.col(f"t{j}"))) for j, lane in enumerate(lanes)],
            F.col("ref"), F.col("n_words"),
        )
    )
    return keep(roots.unionByName(heads).unionByName(tails), "prefixes")


def group_nodes(prefixes: DataFrame) -> DataFrame:
    """Nodes by fingerprint: members, smallest member, ends, and the least and greatest of what must be equal."""
    return keep(
        prefixes.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count(F.when(F.col("ends"), 1)).alias("n_ends"),
            *[F.min(p).alias(p) for p in PARENT], *[F.max(p).alias(f"{p}_most") for p in PARENT],
            F.min("ref").alias("ref"), F.max("ref").alias("ref_most"),
            F.min("n_words").alias("n_words"),
        ),
        "nodes",
    )


def equal_members(nodes: DataFrame, prefixes: DataFrame, turns: DataFrame) -> bool:
    """Whether the members of every node have one parent node and equal last turns.

    Only nodes that more than one stored turn leads to read texts, and each
    such turn once for each node.
    """
    parents = F.lit(False)
    for p in PARENT:
        parents = parents | (F.col(p) != F.col(f"{p}_most"))
    if not nodes.filter(parents).isEmpty():
        return False
    several = nodes.filter("ref <> ref_most").select(*KEY)
    turn = F.struct("role", "text")
    last = (
        prefixes.filter("depth > 0").select(*KEY, "ref").distinct().join(several, KEY).join(turns, "ref")
        .groupBy(*KEY).agg(F.min(turn).alias("least"), F.max(turn).alias("most"))
    )
    return last.filter("least <> most").isEmpty()


def _above(chains: DataFrame) -> DataFrame:
    """``chains`` (conv_id, depth, saved) with ``above``: what the same conversation's nodes of less depth save."""
    pieces = chains.withColumn("piece", F.floor(F.col("depth") / CHAIN_PIECE))
    inside = W.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy("conv_id").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    whole = pieces.groupBy("conv_id", "piece").agg(F.sum("saved").alias("n"))
    whole = whole.select("conv_id", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    summed = pieces.withColumn("near", F.coalesce(F.sum("saved").over(inside), F.lit(0)))
    return summed.join(whole, ["conv_id", "piece"]).withColumn("above", F.col("skip") + F.col("near")).drop(
        "piece", "near", "skip"
    )


def _digest_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which come one after another."""
    at, state, done = None, None, []

    def rows(some: list) -> pa.RecordBatch:
        columns = list(zip(*some)) or [[] for _ in range(len(KEY) + 1)]
        kinds = [pa.int64()] * len(KEY) + [pa.string()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [*KEY, "ends_sha256"])

    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in KEY])
        for key, ids in zip(keys, batch.column("ids").to_pylist()):
            if key != at:
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield rows(done)
        done = []
    if at is not None:
        yield rows([(*at, state.hexdigest())])


def ends_digests(prefixes: DataFrame) -> DataFrame:
    """(depth, f<j>, ends_sha256): digest of the ascending ids of the conversations that end at each node.

    Ids are joined in short pieces in their order first, over as many tasks as
    there are; the digest, which must read them in turn, sees pieces only.
    """
    ends = prefixes.filter("ends").select(*KEY, "conv_id")
    placed = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    numbered = keep(placed.withColumn("piece", F.shiftright(F.monotonically_increasing_id(), ENDS_PIECE.bit_length() - 1)), "ends")
    pieces = numbered.groupBy(*KEY, "piece").agg(
        F.concat_ws(",", F.sort_array(F.collect_list("conv_id")).cast("array<string>")).alias("ids")
    )
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece")
    schema = ", ".join(f"{c} long" for c in KEY) + ", ends_sha256 string"
    return ordered.select(*KEY, "ids").mapInArrow(_digest_in_order, schema)


def trie(
    conversations: DataFrame, moduli: Iterable[tuple[int, ...]] = itertools.repeat(PRIMES)
) -> DataFrame:
    """One row for each node of the trie of all rebuilt conversations.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256). ``moduli`` are the primes of one attempt after
    another; the next is taken when a node holds unequal prefixes.
    """
    turns = stored_turns(conversations)
    for attempt, primes in enumerate(moduli):
        lanes = [Lane(j, p, attempt) for j, p in enumerate(primes)]
        products = running_products(turns, lanes)
        prefixes = rebuilt_prefixes(products, plans(products), lanes)
        nodes = group_nodes(prefixes)
        if equal_members(nodes, prefixes, turns):
            return _measured(nodes, prefixes)
    raise RuntimeError("prefixes with equal fingerprints differ in every attempt")


def _measured(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Children, leaves, savings and digests of verified nodes."""
    marked = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("n_words")).withColumn(
        "leaf", (F.col("n_ends") == F.col("n_convs")).cast("bigint")
    )
    chains = marked.groupBy("conv_id").agg(F.sum("saved").alias("chain_saved"), F.sum("leaf").alias("chain_leaves"))
    below = prefixes.select(*KEY, "conv_id").join(chains, "conv_id").groupBy(*KEY).agg(
        F.sum("chain_saved").alias("members_saved"), F.sum("chain_leaves").alias("n_leaves")
    )
    key_of_parent = [(F.col("depth") - 1).alias("depth"), *[F.col(f"p{j}").alias(f"f{j}") for j in LANES]]
    children = nodes.filter("depth > 0").select(*key_of_parent).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    held = keep(
        _above(marked.select(*KEY, *PARENT, "conv_id", "n_convs", "n_ends", "saved"))
        .join(below, KEY).join(children, KEY, "left"),
        "measured",
    )
    digests = ends_digests(prefixes)
    parents = held.select(
        (F.col("depth") + 1).alias("depth"), *[F.col(f"f{j}").alias(f"p{j}") for j in LANES],
        F.col("conv_id").alias("parent_conv_id"),
    )
    return held.join(digests, KEY, "left").join(parents, ["depth", *PARENT], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        "n_leaves", (F.col("members_saved") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
