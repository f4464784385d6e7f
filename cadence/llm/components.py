"""Connected components of a graph given as edges, on Spark.

Alternating star contraction: each round joins every node's larger neighbours
to its smallest neighbour, then its smaller neighbours to the smallest, until
every edge ends in the smallest node of its component. Rounds grow with the
logarithm of the longest chain. Only per-node minima are aggregated (with
map-side combine), so a node with very many edges is no hot group, and each
round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import written


def _smallest(edges: DataFrame) -> DataFrame:
    """Each node with its smallest neighbour or itself, whichever is smaller."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("least"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node on an edge; root is the smallest node
    reachable. ``edges`` has columns a and b; repeats and loops do no harm."""
    pairs = written(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        least = written(_smallest(pairs), "least")
        # Large star: each end of an edge takes the other end's smallest neighbour.
        down = least.select(F.col("node").alias("b"), F.col("least").alias("lb"))
        large = pairs.join(down, "b").select("a", F.col("lb").alias("b"))
        up = least.select(F.col("node").alias("a"), F.col("least").alias("la"))
        small = pairs.join(up, "a").select("b", F.col("la").alias("a"))
        stars = (large.unionByName(small.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
                 .where(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        new = written(stars, "edges")
        # Stars: every node has one edge, and no root is itself below another.
        many = new.groupBy("a").count().where(F.col("count") > 1).limit(1).count()
        inner = 0 if many else new.select("b").distinct().join(new.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        pairs = new
        if not many and not inner:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
