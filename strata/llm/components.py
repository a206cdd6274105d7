"""Connected components of a graph given as an edge table, by alternating star contraction.

Each round first links every neighbour larger than a node to the smallest of the node and its neighbours, then does the
same among the smaller ones; once the edges are stars, every node points to the smallest node of its component.  A
minimum per node (partially aggregated) and a join carry out a round, so a node with very many neighbours is neither
collected nor held in one task.  Each round is checkpointed, and the copy of the round before deleted.  Edges that are
measured to be few go through a round as one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, gathered, is_small, together


def _open(e: DataFrame) -> int:
    """Nodes that keep the edges from being stars: with several smaller neighbours, or with a smaller and a larger one."""
    sides = together(e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))), e)
    nodes = sides.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)).count()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node on an edge between different nodes; root is the component's smallest node.

    A result whose edges are measured to be few is marked for broadcast in the joins that follow.
    """
    e = gathered(checkpoint(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()))
    while _open(e):
        both = together(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))), e)
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: e has u > v, so every larger neighbour u of v goes to the smallest around v
        e1 = e.join(low.select(F.col("u").alias("v"), "m"), "v").select("u", F.col("m").alias("v")).where("u <> v")
        e1 = e1 if is_small(e) else e1.repartition("u")
        least = e1.groupBy("u").agg(F.min("v").alias("m"))
        # small star: the smaller neighbours of u, and u itself, go to the smallest of them
        e2 = (e1.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
              .unionByName(least.select("u", F.col("m").alias("v"))))
        e = gathered(checkpoint(together(e2, e).distinct(), e))
    out = together(e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), e)
    out = F.broadcast(out) if is_small(e) else out
    out._copy = e._copy         # so that the caller can discard it
    return out
