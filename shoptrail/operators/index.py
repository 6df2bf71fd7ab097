"""Inverted index: the users of each item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.text import id_order, is_plain_number
from shoptrail.operators.pairs import attach, degrees, without, written_pairs
from shoptrail.operators.positions import numbered
from shoptrail.sources.durable import durable

BLOCK_USERS = 100_000


def _sorted_ids(ids: Column, numbers: bool) -> Column:
    """All ``ids`` of a group in id order."""
    if numbers:
        ordered = F.sort_array(F.collect_list(ids.cast("bigint")))
        return F.transform(ordered, lambda n: n.cast("string"))
    # Only ids are shuffled; their sort keys are made after it.
    ordered = F.sort_array(F.transform(F.collect_list(ids), id_order))
    return F.transform(ordered, lambda s: s["id"])


def item_user_index(pairs: DataFrame, block_users: int = BLOCK_USERS) -> DataFrame:
    """Per item its users in id order: ``(item_id, block, users)``.

    The list of an item is cut every ``block_users`` users, and its blocks are
    numbered from 0, so an item has as many rows as its own users ask for,
    whatever other items there are. Only items with more users than that are
    ranked by a distributed sort; the others are in block 0 anyway.
    """
    pairs = written_pairs(pairs)
    first = F.lit(0).cast("bigint").alias("block")
    large = durable(
        degrees(pairs, "item_id").where(F.col("degree") > block_users), "large-items"
    )
    if large.isEmpty():
        blocked = pairs.select("user_id", "item_id", first)
    else:
        rows = pairs.count()
        small = without(pairs, large, "item_id", rows).select("user_id", "item_id", first)
        blocked = small.unionByName(_cut(attach(pairs, large, "item_id", rows), block_users))
    user = F.col("user_id")
    # Where all ids are plain numbers, which one scan tells, they sort as such.
    numbers = pairs.where(~is_plain_number(user)).isEmpty()
    return blocked.groupBy("item_id", "block").agg(_sorted_ids(user, numbers).alias("users"))


def _cut(pairs: DataFrame, block_users: int) -> DataFrame:
    """Pairs with the block of the user: its rank within the item, by blocks.

    One sort numbers the pairs by item and user; an item's first number is
    where its ranks begin.
    """
    ranked = durable(
        numbered(pairs.select("user_id", "item_id"), F.col("item_id"), id_order(F.col("user_id"))),
        "ranked-pairs",
    )
    starts = durable(
        ranked.groupBy("item_id").agg(
            F.min("position").alias("start"), F.count(F.lit(1)).alias("degree")
        ),
        "starts",
    )
    block = F.floor((F.col("position") - F.col("start")) / block_users).alias("block")
    return attach(ranked, starts, "item_id", ranked.count()).select("user_id", "item_id", block)
