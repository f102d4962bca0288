"""Connected components of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.keys import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``node, comp`` for every node of ``links`` (``a``, ``b``): the smallest node that can be reached.

    Every round ties each node's larger neighbours to the smallest one (large
    star), then its smaller neighbours (small star), until no link changes; the
    number of rounds grows with the logarithm of the longest path. The smallest
    neighbour is a grouped minimum, so a node with very many links costs one row per task.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "links")
    before = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = stored(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        edges = stored(small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
