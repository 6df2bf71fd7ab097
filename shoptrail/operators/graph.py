"""The user-item graph: nodes, links and directed edges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.constants import ITEM, USER
from shoptrail.operators.pairs import attach, degrees, written_pairs
from shoptrail.sources.durable import durable


@dataclass
class Graph:
    """Numbered nodes and the links between them, all written tables.

    ``users`` is ``(user_id, degree, user)``, ``items`` is ``(item_id, degree,
    item)``; ``links`` has both ends of each pair with their degrees. Numbers
    are arbitrary, they only keep the links narrow.
    """

    users: DataFrame
    items: DataFrame
    links: DataFrame


def build_graph(pairs: DataFrame) -> Graph:
    pairs = written_pairs(pairs)
    rows = pairs.count()
    users = _numbered(pairs, "user_id", "user")
    items = _numbered(pairs, "item_id", "item")
    by_user = attach(pairs, users, "user_id", rows).withColumnRenamed("degree", "user_degree")
    links = attach(by_user, items, "item_id", rows).withColumnRenamed("degree", "item_degree")
    links = links.select("user", "user_degree", "item", "item_degree")
    return Graph(users, items, durable(links, "links"))


def _numbered(pairs: DataFrame, key: str, number: str) -> DataFrame:
    # The number depends on the partitioning; written once, it is fixed.
    return durable(
        degrees(pairs, key).withColumn(number, F.monotonically_increasing_id()), number
    )


def graph_nodes(pairs: DataFrame) -> DataFrame:
    """Every node with its degree: ``(kind, id, degree)``."""
    users = degrees(pairs, "user_id").withColumnRenamed("user_id", "id")
    items = degrees(pairs, "item_id").withColumnRenamed("item_id", "id")
    return (
        users.withColumn("kind", F.lit(USER))
        .unionByName(items.withColumn("kind", F.lit(ITEM)))
        .select("kind", "id", "degree")
    )


def _edge(src_kind: str, src: str, dst_kind: str, dst: str, degree: str) -> Column:
    return F.struct(
        F.lit(src_kind).alias("src_kind"),
        F.col(src).alias("src"),
        F.lit(dst_kind).alias("dst_kind"),
        F.col(dst).alias("dst"),
        (F.lit(1.0) / F.col(degree)).alias("p"),
    )


def graph_edges(pairs: DataFrame) -> DataFrame:
    """Both directions of every pair, with the chance ``p`` of taking it.

    The kind of a node is a column, so a user and an item may share an id.
    """
    pairs = written_pairs(pairs)
    rows = pairs.count()
    users = durable(degrees(pairs, "user_id"), "user-degrees")
    items = durable(degrees(pairs, "item_id"), "item-degrees")
    by_user = attach(pairs, users, "user_id", rows).withColumnRenamed("degree", "user_degree")
    ends = attach(by_user, items, "item_id", rows).withColumnRenamed("degree", "item_degree")
    there = _edge(USER, "user_id", ITEM, "item_id", "user_degree")
    back = _edge(ITEM, "item_id", USER, "user_id", "item_degree")
    return ends.select(F.inline(F.array(there, back)))
