"""Connected components of links, by alternating large and small stars.

Every round is a handful of joins and aggregates over the edges; the driver sees a count and a checksum. A hub's edges
are never gathered: its smallest neighbour is a partial aggregate and is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.session import stored


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(a, b)`` to ``(node, root)``: for every node in a link the smallest node that it reaches.

    Links of a node with itself and links with a null end say nothing; repeated links count once.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = stored(links.where("a <> b").select(larger, smaller).distinct(), label)
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").where("u <> v").distinct(), label)
