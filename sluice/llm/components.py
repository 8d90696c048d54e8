"""Connected components of a graph too large for one task.

Alternates two steps, each a join and an aggregation, until only stars are left:
every node hands its larger neighbours to the smallest node it knows ("large
star"), then its smaller neighbours and itself ("small star").  The number of
rounds grows with the logarithm of the longest chain.  A node of very high
degree is a skewed key of a sort-merge join, which adaptive execution splits;
minima are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to its root and no root has one of its own."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    odd = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return odd.where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1))).isEmpty()


def _star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges with the smallest neighbour ``m`` of their ``u``, those minima)."""
    least = materialise(edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")), "cc-least")
    return edges.hint("merge").join(least.hint("merge"), F.col("u") == F.col("n")), least


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links`` but the roots; root is the smallest node it can reach."""
    edges = materialise(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where("u > v").distinct(), "cc-links")
    while not _is_stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, _ = _star(both)
        large = materialise(large.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(),
                            "cc-large")
        small, least = _star(large)
        edges = materialise(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionAll(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct(), "cc-small")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
