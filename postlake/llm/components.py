"""Connected components of an edge list, with alternating star contractions.

Every step is an aggregate and a join (AQE splits a skewed one); no group of
neighbours is ever collected, and each round's edges are written to the
shared folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import materialize


def _lowest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long) that is not its component's smallest.

    Loops, repeated edges and both directions are allowed; no edges give no rows.
    """
    edges = materialize(edges.filter("u <> v").select("u", "v"), "edges")
    before = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
