"""Entity co-occurrence (J5, G1, G2) and influence on prices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.joins import asof_join


def cooccurrence_pairs(documents: DataFrame, entities: str = "entities") -> DataFrame:
    """Edges (src < dst, weight = number of documents) between entities named together.

    Documents are first grouped by their set of entities, so copies of a text count once and only carry a weight; pairs
    are then unrolled row by row from the sorted set, and equal pairs are combined before the shuffle. Nothing is
    gathered and no join is made. A set holds at most one entry per gazetteer line.
    """
    sets = documents.select(F.sort_array(F.array_distinct(entities)).alias("_e")).where(F.size("_e") > 1)
    sets = sets.groupBy("_e").agg(F.count(F.lit(1)).alias("_n"))
    left = sets.select("_e", "_n", F.posexplode("_e").alias("_i", "src")).where(F.col("_i") < F.size("_e") - 1)
    pairs = left.select("src", "_n", F.explode(F.slice("_e", F.col("_i") + 2, F.size("_e"))).alias("dst"))
    return pairs.groupBy("src", "dst").agg(F.sum("_n").alias("weight"))


def entity_nodes(documents: DataFrame, entities: str = "entities") -> DataFrame:
    return documents.select(F.explode(F.array_distinct(entities)).alias("entity")).distinct()


def entity_degree(edges: DataFrame) -> DataFrame:
    """G1: neighbours and total weight per entity in the simple undirected graph."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("entity"), "weight")
    return ends.groupBy("entity").agg(F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("weight"))


def degree_centrality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Degree / (n - 1) for every node, isolated ones included; a single node has 1."""
    size = nodes.agg(F.count(F.lit(1)).alias("_n"), F.lit(1).alias("_k"))  # one row
    ranked = nodes.join(entity_degree(edges).select("entity", "degree"), "entity", "left").withColumn("_k", F.lit(1))
    ranked = ranked.join(F.broadcast(size), "_k").withColumn("degree", F.coalesce("degree", F.lit(0)))
    centrality = F.when(F.col("_n") <= 1, F.lit(1.0)).otherwise(F.try_divide(F.col("degree").cast("double"), F.col("_n") - 1))
    return ranked.select("entity", "degree", centrality.alias("centrality"))


# The counters whose influence on the price is measured.
COUNTERS = ("followers_count", "retweets", "likes", "replies", "shares", "views", "comments", "mentions")


def influencer_impact(posts: DataFrame, market: DataFrame, posts_ts: str, market_ts: str, keys: Sequence[str] = (),
                      counters: Sequence[str] = COUNTERS, price: str = "close") -> tuple[DataFrame, object]:
    """Price at the time of each post, a linear model of it on the counters, and its prediction ``impact_score``.

    Posts with a missing counter are not learned from and get no score.
    """
    joined = asof_join(posts, market, posts_ts, market_ts, keys, prefix="market_")
    return fit_impact(joined, counters, f"market_{price}")


def fit_impact(priced: DataFrame, counters: Sequence[str], target: str) -> tuple[DataFrame, object]:
    """The model half of ``influencer_impact``, on posts that know the price at their time."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in counters])
    assembled = VectorAssembler(inputCols=list(counters), outputCol="_x", handleInvalid="keep").transform(priced)
    model = LinearRegression(featuresCol="_x", labelCol=target, predictionCol="impact_score", solver="normal").fit(
        assembled.where(F.col(target).isNotNull() & known))
    return model.transform(assembled).withColumn("impact_score", F.when(known, F.col("impact_score"))).drop("_x"), model
