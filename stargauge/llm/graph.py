"""Connected components of links, as joins and minima that no large node can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every linked node: the smallest node it can reach.

    Alternates two steps on written edge tables until nothing changes: every node passes its smallest neighbour to
    its larger neighbours, then to its smaller ones. The edges end as stars around the smallest node. Minima are
    combined before the exchange; a node with very many links is one long side of a join, which Spark splits.
    """
    edges = links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u != v").distinct()
    edges, before = written(edges, "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.max("u")).first()
        if tuple(state) == before or state[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = tuple(state)
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(edges.join(least, "u").where("m = v").select("u", "v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        edges = written(small.distinct(), "edges")
