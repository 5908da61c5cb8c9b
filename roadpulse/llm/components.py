"""Connected components by alternating large and small stars.

Each round hangs every node's larger neighbours on its smallest one, then its smaller neighbours,
until all edges lead from a node to the least of its component. Edges stay as many as there were;
each round is grouping and joins on the nodes, written out before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node that can be reached. Loops and repeats may occur."""
    a, b = F.col("a"), F.col("b")
    current = cut_lineage(edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    while before != (now := _checksum(current)):
        before = now
        both = current.union(current.select("v", "u"))
        # Written before they are joined: then AQE can split a hub with very many edges.
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = cut_lineage(large)
        lowest = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        current = cut_lineage(small.union(lowest.select("u", F.col("m").alias("v"))).distinct())
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
