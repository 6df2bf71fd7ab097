"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.sources.durable import durable


def connected(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of the links ``(a, b)``; the root is its least node.

    Large stars hang the greater neighbours of a node on its least neighbour,
    small stars the lesser ones. The number of links never grows, and a path of
    n nodes needs about log n rounds. Each round is a written table. Without
    links the result is empty.
    """
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    )
    edges = durable(edges.distinct(), "links")
    before = None
    while (now := _signature(edges)) != before:
        before = now
        edges = durable(_small_star(_large_star(edges)), "stars")
    return edges


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(
        edges.select(F.col("root").alias("node"), F.col("node").alias("root"))
    )
    least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
    greater = both.where(F.col("root") > F.col("node"))
    return greater.join(least, "node").select(
        F.col("root").alias("node"), F.col("least").alias("root")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    others = edges.join(least, "node").where(F.col("root") != F.col("least"))
    return (
        others.select(F.col("root").alias("node"), F.col("least").alias("root"))
        .unionByName(least.withColumnRenamed("least", "root"))
        .distinct()
    )
