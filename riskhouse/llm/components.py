"""Connected components of links by alternating large and small stars; every round is joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm.common import shared_checkpoint


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node u, or u itself; map tasks combine first."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.  Nodes without a link are not listed.

    The number of rounds grows with the logarithm of the longest path; no component, and no node's neighbours,
    are ever gathered in one place: a hub's rows are a skewed join, which Spark deals out.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = shared_checkpoint(edges)
    size, total = None, None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both).withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        near = _least(large).withColumnRenamed("u", "w")
        small = large.join(near, F.col("u") == F.col("w")).select("v", "m", "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = shared_checkpoint(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (now[0], now[1]) == (size, total):
            break
        size, total = now
    return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
