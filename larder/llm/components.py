"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.llm.common import dropped, stored


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: bigint); the root is the component's least node.

    Alternates two steps until nothing changes. In the large step every node
    hands the least node it knows to its greater neighbours; in the small step
    to itself and its lesser ones. Both keep the components, and the number of
    rounds grows with the logarithm of the number of nodes. Every round is a
    written table; minima are stored too, so that the join that gives them back
    can split a node of many links over tasks. Loops and repeated links are
    allowed; no links give no rows.
    """
    edges = stored(links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    before = None
    while (now := _summary(edges)) != before:
        before, old = now, edges
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "least")
        large = both.where("a < b").join(least, "a").selectExpr("b AS a", "low AS b").distinct()
        low = F.min("b").alias("low")
        lesser = large.groupBy("a").agg(low, F.collect_set("b").alias("all"))
        # after the large step a node has few lesser neighbours left
        small = lesser.select(F.explode(F.array_union("all", F.array("a"))).alias("a"), F.col("low").alias("b"))
        edges = stored(small.where("a <> b").distinct(), "links")
        dropped(least)
        dropped(old)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())
