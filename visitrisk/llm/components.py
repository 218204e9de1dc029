"""Connected components of an edge table by alternating large-star and small-star steps, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitrisk.llm.common import stored


def _star(neighbours: DataFrame, larger: bool) -> DataFrame:
    """Every node's neighbours linked to the least of them and the node. ``neighbours`` has (a, b).

    ``larger``: only the neighbours larger than the node move (large star); else all given, and the node too.
    The least neighbour is found with partial sums before the shuffle. The join's second key gives both sides
    an exchange of their own, which adaptive execution splits where a node has very many neighbours.
    """
    least = neighbours.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"), F.xxhash64("a").alias("own"))
    moved = neighbours.withColumn("own", F.xxhash64("a")).join(least, ["a", "own"])
    if larger:
        return moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node that can be reached.

    Nodes are of any one type with an order; NULL ends and loops carry no link. Each round is written to the
    shared folder. Rounds grow with the logarithm of the longest path; the loop ends when no edge changes.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(links, "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        after = stored(_star(_down(_star(both, larger=True)), larger=False), "links")
        if _state(after) == _state(links):
            break
        links = after
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _down(edges: DataFrame) -> DataFrame:
    """Each edge from its larger end to its smaller."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _state(links: DataFrame) -> tuple:
    """Number of the links and two sums over them, which change when the set of links does."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.crc32(F.concat_ws(" ", "a", "b")))).first()
    return tuple(row)
