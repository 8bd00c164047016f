"""Connected components over an edge table, by alternating star contractions.

Large-star hangs every larger neighbour of a node on the smallest node of its neighbourhood,
small-star does the same with the smaller ones; repeated until nothing moves, every component ends as
a star around its smallest node.  Each step is one aggregate (combined before its shuffle) and one join on the node, so
a hub's rows can be split among tasks; no adjacency list is ever collected.  Rounds are written to
the shared folder, and only a count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.runtime import discard, staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(low.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node with an edge to another node; component is its smallest node.

    Self-loops and repeated edges are allowed, rows with a null end are left out.  An empty table has
    no components.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    now = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), a.alias("a"), b.alias("b")).where("a <> b").select("u", "v").distinct(), "edges")
    before = None
    while True:
        seal = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not seal["n"] or seal == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
        before = seal
        after = staged(_small_star(_large_star(now).distinct()).distinct(), "edges")
        discard(now)
        now = after
