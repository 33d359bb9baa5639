"""Connected components of a link table by alternating large-star and small-star steps.

Large star: every node links its larger neighbours to the smallest node next to it. Small star: every
node links its smaller neighbours and itself to the smallest of them. Each step keeps the components and
brings every node nearer to its smallest; about log(n) rounds leave stars around the smallest nodes.
Steps are one aggregate and one join each; every round is written, so a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glebe.llm.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u").where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") > F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of 64-bit nodes, any direction → (node, root): root is the smallest node of the component.

    Nodes without a link (or linked to themselves only) do not appear; a root does not appear as a node.
    """
    start = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(start, "components")
    mark = _mark(edges)
    while mark[0]:
        edges = staged(_small_star(staged(_large_star(edges), "components")), "components")
        after = _mark(edges)
        if after == mark:
            break
        mark = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Two equal marks in a row: nothing moved any more."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
