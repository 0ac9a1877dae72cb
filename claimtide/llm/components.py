"""Connected components by alternating stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of `links` (a, b): the smallest node that each reaches.

    Null ends are left out. No links: no rows.
    """
    edges = stored(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    state = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == state:
            break
        state = tuple(mark)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.where("u <> v"), "links")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "links")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
