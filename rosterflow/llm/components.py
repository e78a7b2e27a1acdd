"""Connected components of a frame of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")).head()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (``a``, ``b``): the smallest node it is connected with.

    A large star moves each node's larger neighbours to its smallest one, a small star
    its smaller neighbours; alternating, all edges come to point at the components'
    smallest nodes in a number of rounds that grows with the logarithm of the longest
    path.  Minima are combined before the shuffle and joined back as the small side, so
    that a node with very many neighbours is split.  Each round is written to the shared folder.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = materialize(links.where("a <> b").select(larger.alias("v"), smaller.alias("u")).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("hub"), F.least("m", "v").alias("m"))
        large = both.where("u > v").join(least, F.col("v") == F.col("hub")).select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = materialize(large, "edges")
        least = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("hub"), "m")
        joined = large.join(least, F.col("v") == F.col("hub"))
        small = joined.select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u")
        edges = materialize(small.unionByName(least.select(F.col("hub").alias("v"), F.col("m").alias("u"))).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    pointed = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return pointed.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component"))).groupBy("node").agg(
        F.min("component").alias("component")
    )
