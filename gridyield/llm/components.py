"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link to another node; component: the smallest reachable id.

    Loops, repeated links, both directions and null ends are allowed; nodes without a link are left out.
    Every step is an aggregate with map-side combine or a join of two written tables, so hubs are split
    by the adaptive skew join, and the number of rounds grows with the logarithm of the longest path.
    """
    low, high = F.least(a, b).alias("b"), F.greatest(a, b).alias("a")
    edges = written(links.where(F.col(a) != F.col(b)).select(high, low).distinct(), "links")
    state = _state(edges)
    while state[0]:
        # a > b in every edge. Large star: larger neighbours of u move to the smallest neighbour of u.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = written(least, "least")
        # Larger neighbours of u are the rows whose smaller end is u.
        star = edges.withColumnRenamed("b", "u").join(least.withColumnRenamed("a", "u"), "u").select("a", F.col("m").alias("b"))
        star = written(star.distinct(), "star")
        # Small star: u and its smaller neighbours move to the smallest of them.
        least = written(star.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = star.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        last, state = state, _state(edges)
        if state == last:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
