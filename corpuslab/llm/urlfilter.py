"""Verdicts on page addresses: host rules first, then learnt path templates.

Per host the paths form a tree. Level by level, a position whose values hardly
repeat becomes a wildcard, and the remaining branches of a node are merged
while neither their labels nor their ends tell them apart. Under a node of many
branches, those of like shares and support are added up first and merged as one
kind. A path's node in the finished tree is its template; a template is rejected
when the smoothed share of good labels on it is too low.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.llm.store import keep
from corpuslab.session import lookup

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The rules of the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@dataclass(frozen=True)
class Tree:
    """``deepest``: segments beyond it count as one. ``few``, ``spread``: a position with more than
    ``few`` values, and more than ``spread`` values for each address, is a wildcard. ``most``: branches
    of a node that are merged one by one, above it by kind. ``alpha``: error level at which two branches
    differ. ``weight``: labels that the overall share counts for. ``purity``: least smoothed share of
    good labels."""

    deepest: int = 12
    few: int = 5
    spread: float = 0.3
    most: int = 50
    alpha: float = 0.05
    weight: float = 10.0
    purity: float = 0.5


def _rest(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    return F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits host and path; nulls where none does."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, rule in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        name, action = F.when(fits, rule).otherwise(name), F.when(fits, act).otherwise(action)
    return name, action


def _differ(a: tuple[int, int], b: tuple[int, int], bound: float) -> bool:
    """Whether two shares, as (hits, trials), differ by more than chance allows (Hoeffding)."""
    if not a[1] or not b[1]:
        return False
    return abs(a[0] / a[1] - b[0] / b[1]) > bound * (1 / math.sqrt(a[1]) + 1 / math.sqrt(b[1]))


def _groups(branches: list[tuple], alpha: float) -> list[list]:
    """Keys of the merged branches of (key, branches of that kind, n, ends, good, bad); a kind is tested as its average branch."""
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    groups: list[dict] = []
    for key, m, n, ends, good, bad in sorted(branches, key=lambda b: (-(b[4] + b[5]) / b[1], -b[2] / b[1], b[0])):
        for g in groups:
            if not _differ((bad / m, (good + bad) / m), (g["bad"], g["good"] + g["bad"]), bound) and not _differ(
                (ends / m, n / m), (g["ends"], g["n"]), bound
            ):
                break
        else:
            g = {"n": 0, "ends": 0, "good": 0, "bad": 0, "keys": []}
            groups.append(g)
        for k, v in (("n", n), ("ends", ends), ("good", good), ("bad", bad)):
            g[k] += v
        g["keys"].append(key)
    return [g["keys"] for g in groups]


def merge_branches(branches: list[tuple], alpha: float) -> dict[str, str]:
    """Name of the merged branch of each (segment, n, ends, good, bad); at most ``Tree.most`` of them."""
    groups = _groups([(b[0], 1, *b[1:]) for b in branches], alpha)
    return {s: "|".join(sorted(g)) for g in groups for s in g}


def _merger(alpha: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for host, prefix, branches in zip(frame["host"], frame["prefix"], frame["branches"], strict=True):
                listed = [(b["seg"], b["n"], b["ends"], b["good"], b["bad"]) for b in branches]
                rows += [(host, prefix, s, name) for s, name in merge_branches(listed, alpha).items()]
            yield pd.DataFrame(rows, columns=["host", "prefix", "seg", "name"]).astype("string")

    return run


def _kind_merger(alpha: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for host, prefix, kinds in zip(frame["host"], frame["prefix"], frame["kinds"], strict=True):
                listed = [tuple(k[c] for c in ("kind", "m", "n", "ends", "good", "bad")) for k in kinds]
                rows += [(host, prefix, kind, str(i)) for i, g in enumerate(_groups(listed, alpha)) for kind in g]
            yield pd.DataFrame(rows, columns=["host", "prefix", "kind", "part"]).astype("string")

    return run


def _cell(hits: Column, trials: Column) -> Column:
    """Support to a factor of two, and share to a quarter of the deviation that such support leaves open."""
    size = F.floor(F.log2(trials))
    share = F.floor(hits / trials * 4 * F.pow(F.lit(2.0), size / 2))
    return F.when(trials > 0, F.concat_ws(":", size, share)).otherwise("")


def _wide_names(wide: DataFrame, alpha: float) -> DataFrame:
    """(host, prefix, seg, name) of the branches of nodes with many (k) of them: merged by kind, of which a node
    with n addresses has a few times the root of n at most. A merged branch is named by its least segment, and
    by a wildcard if it is all of its node."""
    at = ["host", "prefix"]
    labels = F.col("good") + F.col("bad")
    wide = wide.withColumn("kind", F.concat_ws(" ", _cell(F.col("bad"), labels), _cell(F.col("ends"), F.col("n"))))
    kinds = wide.groupBy(*at, "kind").agg(
        F.count("*").alias("m"), *(F.sum(c).alias(c) for c in ("n", "ends", "good", "bad"))
    )
    listed = kinds.groupBy(*at).agg(F.collect_list(F.struct("kind", "m", "n", "ends", "good", "bad")).alias("kinds"))
    parts = lookup(listed.mapInPandas(_kind_merger(alpha), "host string, prefix string, kind string, part string"))
    placed = wide.join(parts, [*at, "kind"]).select(*at, "seg", "part", "k")
    name = F.when(F.col("m") == F.col("k"), "*").when(F.col("m") == 1, F.col("least")).otherwise(F.concat("least", F.lit("|*")))
    merged = placed.groupBy(*at, "part").agg(F.count("*").alias("m"), F.min("seg").alias("least"), F.first("k").alias("k"))
    return placed.join(lookup(merged.select(*at, "part", name.alias("name"))), [*at, "part"]).select(*at, "seg", "name")


def templates(paths: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(host, path, template) of distinct (host, path, n, good, bad) rows."""
    segs = F.split(F.expr("substring(path, 2)"), "/", tree.deepest)
    state = keep(
        paths.select("host", "path", segs.alias("segs"), F.lit("").alias("prefix"), "n", "good", "bad"), "paths"
    )
    depth = state.agg(F.max(F.size("segs"))).first()[0] or 0
    for level in range(depth):
        here = state.withColumn("seg", F.get("segs", F.lit(level)))
        ends = F.when(F.size("segs") == level + 1, F.col("n")).otherwise(0)
        children = keep(here.filter("seg is not null").groupBy("host", "prefix", "seg").agg(
            F.sum("n").alias("n"), F.sum(ends).alias("ends"), F.sum("good").alias("good"), F.sum("bad").alias("bad")
        ), "branches")
        nodes = children.groupBy("host", "prefix").agg(F.count("*").alias("k"), F.sum("n").alias("total")).withColumn(
            "wild", (F.col("k") > tree.few) & (F.col("k") > F.col("total") * tree.spread)
        )
        nodes = lookup(nodes.select("host", "prefix", "wild", "k"))
        narrow, wide = (f"not wild and k {sign} {tree.most}" for sign in ("<=", ">"))
        # at most ``most`` branches are left under a node of these
        branches = children.join(nodes.filter(narrow), ["host", "prefix"]).groupBy("host", "prefix").agg(
            F.collect_list(F.struct("seg", "n", "ends", "good", "bad")).alias("branches")
        )
        names = branches.mapInPandas(_merger(tree.alpha), "host string, prefix string, seg string, name string")
        if nodes.filter(wide).head(1):
            names = names.unionByName(_wide_names(children.join(nodes.filter(wide), ["host", "prefix"]), tree.alpha))
        names = lookup(names)
        step = F.when(F.col("seg").isNull(), F.col("prefix")).otherwise(
            F.concat("prefix", F.lit("/"), F.when(F.col("wild"), "*").otherwise(F.col("name")))
        )
        state = keep(
            here.join(nodes, ["host", "prefix"], "left").join(names, ["host", "prefix", "seg"], "left").select(
                "host", "path", "segs", step.alias("prefix"), "n", "good", "bad"
            ),
            "paths",
        )
    return state.select("host", "path", F.col("prefix").alias("template"), "n", "good", "bad")


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, tree: Tree = Tree()) -> DataFrame:
    """One row per page: page_id, host, path, rule, template, purity, verdict.

    ``labels`` has (page_id, good): the labelled addresses. Nulls: a null
    address, or one without ``://``, has an empty host and path and is judged
    by the tree like any other; pages without a label count for the shape of
    the tree only; null labels are left out. Repeated pages are judged alike.
    With no labels at all nothing is rejected. Other columns are not read.
    """
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    marks = labels.filter("good is not null").groupBy("page_id").agg(F.min("good").alias("good"))
    counted = named.join(marks, "page_id", "left").groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce(F.col("good").cast("int"), F.lit(0))).cast("bigint").alias("good"),
        F.sum(F.coalesce((~F.col("good")).cast("int"), F.lit(0))).cast("bigint").alias("bad"),
    )
    placed = templates(counted, tree)
    good, bad = (n or 0 for n in placed.agg(F.sum("good"), F.sum("bad")).first())
    share = good / (good + bad) if good + bad else 1.0
    pure = placed.groupBy("host", "template").agg(
        ((F.sum("good") + tree.weight * share) / (F.sum("good") + F.sum("bad") + tree.weight)).alias("purity")
    )
    scored = placed.select("host", "path", "template").join(lookup(pure), ["host", "template"])
    rule, action = rule_for(F.col("host"), F.col("path"), rules)
    learnt = F.when(F.col("purity") < tree.purity, "block").otherwise("allow")
    return named.join(scored, ["host", "path"]).select(
        "page_id", "host", "path", rule.alias("rule"), "template", "purity",
        F.coalesce(action, learnt).alias("verdict"),
    )
