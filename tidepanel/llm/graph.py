"""Connected components of a link table by alternating stars, one written table per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.session import write_table


def _star(near: DataFrame) -> DataFrame:
    """(a, m): each node and the smallest among itself and its neighbours b."""
    return near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _links(found: DataFrame) -> DataFrame:
    return found.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b), except each component's smallest.

    Large star: every neighbour greater than a node is tied to the node's smallest neighbour.
    Small star: the same for the neighbours that are not greater. Both keep components whole and
    end in stars around the smallest node, in a number of rounds that grows with the logarithm
    of the component's size. Minima are partial sums, so a hub is no hot key there; the joins
    with them have one row per node on one side and are split by the skew rule of adaptive
    execution on the other.
    """
    now = write_table(_links(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "links")
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if seen == mark or not seen["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = seen
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.where(F.col("b") > F.col("a")).join(_star(both), "a")
        large = write_table(_links(large.select(F.col("b").alias("a"), F.col("m").alias("b"))), "links")
        small = large.join(_star(large), "a")
        now = write_table(_links(small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            _star(large).select("a", F.col("m").alias("b")))), "links")
