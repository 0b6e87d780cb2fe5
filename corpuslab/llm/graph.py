"""Connected components by contraction, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm.store import keep


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the least node that a path reaches.

    Each turn every node points to its least neighbour if that is smaller,
    pointers are followed twice, and links are redrawn between what they point
    to; links inside one root go. A turn shortens every path at least by half
    of its local maxima, a star is done in one. Nothing is collected.
    """
    edges = keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    roots = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        hooks = edges.groupBy("u").agg(F.min("v").alias("p"))
        jump = keep(
            hooks.alias("x").join(hooks.alias("y"), F.col("x.p") == F.col("y.u"), "left").select(
                F.col("x.u").alias("u"), F.coalesce("y.p", "x.p").alias("p")
            ),
            "jump",
        )
        roots = roots.join(jump, roots["root"] == jump["u"], "left").select("node", F.coalesce("p", "root").alias("root"))
        a, b = jump.alias("a"), jump.alias("b")
        edges = keep(
            edges.alias("e").join(a, F.col("e.u") == F.col("a.u"), "left").join(b, F.col("e.v") == F.col("b.u"), "left")
            .select(F.coalesce("a.p", "e.u").alias("s"), F.coalesce("b.p", "e.v").alias("t"))
            .select(F.greatest("s", "t").alias("u"), F.least("s", "t").alias("v")).filter("u <> v").distinct(),
            "edges",
        )
    return keep(roots, "roots")
