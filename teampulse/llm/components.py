"""Connected components of an edge list, by alternating large and small stars.

Each round points every node at the smallest node among its neighbours, first for
the larger neighbours, then for the smaller ones.  Rounds grow with the logarithm
of the longest chain.  A round is joins and minima only: no task holds the
neighbours of a node, and a hub is an ordinary skewed join key.  Rounds are written
to the shared folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has an edge; the root is the smallest node of its component.

    ``edges`` has two columns of the same orderable type.  Loops, repeated edges and
    NULL ends are left out; an empty table gives no rows.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = stored(pairs.where(f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL AND u > v").distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).head()
        if state == seen or seen["n"] == 0:
            break
        state, now = seen, stored(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
