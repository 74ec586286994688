"""Connected components of an edge table, by alternating large and small stars.

Every round replaces the edges by edges to smaller neighbours, without ever holding a component in one place: the minimum
of a node's neighbours is a partial aggregate, and the edges meet it in a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import staged
from tideline.staging import unstage


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("_n")).select("u", "v")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("m"))
    return _distinct(both.join(least, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    moved = down.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _distinct(moved.union(least.select(F.col("c").alias("u"), F.col("m").alias("v"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: longs, not NULL); the root is the least node of its component.

    Self-loops and repeated edges do not matter, except that a node known only by a self-loop gets no row. No edges, no rows.
    """
    edges = staged(_distinct(edges.select("u", "v")), "edges")
    mark = None
    while True:
        stars = staged(_small_star(_large_star(edges)), "stars")
        unstage(edges)
        edges = stars
        # All edges point at a root exactly when another round changes nothing; the mark sums up the edges of a round.
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
