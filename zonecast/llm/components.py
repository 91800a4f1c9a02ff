"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.session import materialize


def _largest(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _smallest(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node of its component.

    ``edges`` has two columns ``a`` and ``b`` of one ordered type. Each round writes its edges, so the plan does not grow;
    the driver sees a count and a checksum a round. Rounds grow as the logarithm of the number of nodes, squared at worst.
    """
    edges = materialize(edges.where("a != b").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = materialize(_smallest(materialize(_largest(edges), "edges")), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    nodes = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
