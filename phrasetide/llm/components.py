"""Connected components of links between integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasetide.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("l")).select("l.*")


def _moved(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``rows`` with ``column`` replaced by its parent, where it has one."""
    to = parents.select(F.col("node").alias("moved_node"), F.col("parent").alias("moved_to"))
    return (rows.join(to, F.col(column) == F.col("moved_node"), "left")
            .withColumn(column, F.coalesce("moved_to", column)).drop("moved_node", "moved_to"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for the nodes of links ``a``, ``b``.

    Each round every node joins the neighbour that comes first in an order drawn
    anew by hashing, and the links are contracted, which shrinks them by a
    constant share whatever their shape. Every round's tables are written, so
    both sides of a join are plain shuffles, whose hot keys (the centre of a
    large star) adaptive execution splits; minima are aggregated before the
    shuffle. Links to itself and repeated links don't matter.
    """
    links = written(links.filter(F.col("a") != F.col("b"))
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "links")
    nodes = written(_both_ways(links).select("node").distinct()
                    .select("node", F.col("node").alias("root")), "nodes")
    rounds = 0
    while not links.isEmpty():
        rounds += 1
        order = lambda c: F.xxhash64(c, F.lit(rounds))
        first = (_both_ways(links).groupBy("node")
                 .agg(F.min_by("other", order("other")).alias("first")))
        parents = written(first.select("node", F.when(
            (order("first") < order("node")), F.col("first")).otherwise(F.col("node"))
            .alias("parent")).filter("parent != node"), "parents")
        # Two steps towards the first: most chains are short.
        parents = written(_moved(parents, "parent", parents), "parents")
        nodes = written(_moved(nodes, "root", parents), "nodes")
        moved = _moved(_moved(links, "a", parents), "b", parents)
        links = written(moved.filter("a != b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    least = written(nodes.groupBy("root").agg(F.min("node").alias("component")), "least")
    return nodes.join(least, "root").select("node", "component")
