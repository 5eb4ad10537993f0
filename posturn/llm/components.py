"""Connected components by alternating large and small stars.

Every round is two grouped minima and two equi-joins over the edges; no group
is collected, so a hub with a third of all edges is only a skewed join, which
adaptive execution splits.  The edges of each round are checkpointed to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node with an edge; component is the least node reachable.

    ``edges`` holds undirected pairs of longs; loops, repeats and either
    direction are allowed, null ends are ignored.  Rounds grow with the
    logarithm of the longest path.
    """
    cur = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
           .where("u is not null and v is not null and u <> v").distinct().checkpoint())
    state = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        cur = small.where("u <> v").distinct().checkpoint()
        seen = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
