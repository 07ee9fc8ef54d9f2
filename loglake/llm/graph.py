"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b): the smallest node that can be reached.

    Each step replaces the links by links to smaller nodes: every larger neighbour of a
    node is tied to the node's smallest neighbour, then every node's smaller ones are tied
    together. All steps are minima by key, so a hub's links never meet in one task. The
    steps end when every node hangs on its smallest; their number grows with the logarithm
    of the nodes. Every step is a written table. Loops and repeated links do no harm.
    """
    edges = staged(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    mark = fingerprint(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("b"), F.col("a")).toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        lowest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lowest, "b").select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        edges = staged(small.filter("a <> b").distinct(), "links")
        before, mark = mark, fingerprint(edges)
        if mark == before:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )


def fingerprint(edges: DataFrame) -> tuple:
    """Number of links and two sums of their hashes: equal for equal sets of links."""
    one, two = F.xxhash64("a", "b"), F.xxhash64("b", "a", F.lit(1))
    return tuple(edges.agg(F.count("*"), F.bit_xor(one), F.bit_xor(two)).first())
