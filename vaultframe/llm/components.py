"""Connected components of an edge table, by alternating large-star and small-star steps.

Edges and labels stay in Spark: every step is a grouped minimum and a join, so a
node with very many neighbours sends one row per input task and is split by AQE
in the join. Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u``, ``v`` of any ordered type -> ``node``, ``root`` (the least node reachable).

    Only nodes with an edge to another node are returned. Null ends and loops are
    ignored, repeated edges count once, and no edges give no rows.
    """
    current = stage(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        current = stage(_small_star(_large_star(current)), "edges")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    inner = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return inner.union(roots)
