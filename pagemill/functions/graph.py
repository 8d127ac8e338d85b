"""Connected components of graphs of any size, many graphs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.spans import stored


def component_roots(edges: DataFrame, graph: str) -> DataFrame:
    """``(<graph>, node, root)`` for the nodes of ``edges`` ``(<graph>, a, b)``: the smallest node that can be reached.

    In turns, each node's larger neighbours and then its smaller ones are linked to the smallest node around it (large and small
    stars), until only stars are left: a number of rounds that grows with the logarithm of the size. Each round is stored.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(graph, "a", "b"))).first())

    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    current = stored(edges.where("a <> b").select(graph, low, high).distinct(), "component-edges")
    before = state(current)
    while before[0]:
        turned = current.select(graph, F.col("b").alias("u"), F.col("a").alias("v"))
        both = current.select(graph, F.col("a").alias("u"), F.col("b").alias("v")).unionByName(turned)
        least = both.groupBy(graph, "u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, [graph, "u"]).select(graph, F.col("m").alias("a"), F.col("v").alias("b"))
        large = stored(large.distinct(), "component-large")
        least = large.groupBy(graph, F.col("b").alias("u")).agg(F.min("a").alias("m"))
        moved = large.select(graph, F.col("b").alias("u"), F.col("a").alias("v")).join(least, [graph, "u"])
        small = moved.select(graph, F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b")).where("a < b")
        current = stored(small.distinct(), "component-small")
        after = state(current)
        if after == before:
            break
        before = after
    leaves = current.select(graph, F.col("b").alias("node"), F.col("a").alias("root"))
    return leaves.unionByName(current.select(graph, F.col("a").alias("node"), F.col("a").alias("root")).distinct())
