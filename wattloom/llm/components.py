"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.session import fresh_dir
from wattloom.sources.folders import Folders


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """node, root for every node that an edge joins to another; root is the smallest node reachable.

    Both stars combine per node before the shuffle and keep at most as many edges as there were, so a
    node with very many neighbours costs no more than its edges. Each step is written to the shared
    folder and the one before it removed. Edges with a null end and loops are nothing; repeated edges count once.
    """
    a, b = F.col(left), F.col(right)
    pairs = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    spark = edges.sparkSession
    places: list[str] = []

    def held(rows: DataFrame) -> DataFrame:
        places.append(fresh_dir(spark, "edges"))
        rows.write.parquet(places[-1])
        for place in places[:-1]:  # the step before is not needed any more
            Folders(spark).remove(place)
        del places[:-1]
        return spark.read.schema(rows.schema).parquet(places[-1])

    pairs = held(pairs)
    before = _state(pairs)
    while True:
        pairs = held(_small_star(_large_star(pairs)))
        after = _state(pairs)
        if after == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
