"""Connected components of a table of links, by alternating large and small stars.

Each step links nodes to the smallest neighbour they know of; the table never has
more rows than links, no node's neighbours are gathered in one place (minima are
pre-aggregated), and every step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) of every node in ``links`` (a, b), both longs.

    Links to oneself and links with a null end are left out.
    """
    def print_of(df: DataFrame):
        return tuple(df.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = print_of(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
        now = print_of(edges)
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
