"""Distinct deep user-item pairs, and joins on keys that may be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.constants import DEEP_BEHAVIORS
from shoptrail.sources.durable import durable

# A key with more rows than a quarter of an average shuffle partition is hot.
# With n partitions there are fewer than 4 n hot keys, whatever the data, so
# they can be broadcast.
HOT_PER_PARTITION = 4
# The most keys that are broadcast; a whole table only after it was counted.
BROADCAST_KEYS = 100_000
# The most keys of one shuffle partition that are hashed for a join, not sorted.
HASH_KEYS = 500_000


def deep_pairs(log: DataFrame) -> DataFrame:
    """Each (user, item) with at least one cart, favourite or buy, once.

    Duplicates collapse on the map side, and the shuffle is on both columns,
    so neither a hot user nor a hot item makes a large partition.
    """
    return (
        log.where(F.col("behavior").isin(*DEEP_BEHAVIORS))
        .select("user_id", "item_id")
        .distinct()
    )


def written_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs``, distinct as ``deep_pairs`` makes them, as a written table.

    Several passes read them. A table that is written already stays as it is.
    """
    if pairs.columns != ["user_id", "item_id"]:
        pairs = pairs.select("user_id", "item_id")
    return durable(pairs, "pairs")


def degrees(pairs: DataFrame, key: str) -> DataFrame:
    """Number of pairs per value of ``key`` as ``degree``."""
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("degree"))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _is_hot(keyed: DataFrame, rows: int, tasks: int | None = None) -> Column:
    share = min(HOT_PER_PARTITION * (tasks or partitions(keyed)), BROADCAST_KEYS)
    return F.col("degree") * share > F.lit(rows)


def _cold_keys(keyed: DataFrame, rows: int, keys: int) -> DataFrame:
    """The other keys, as the hashed side of a join if they are few enough."""
    cold = keyed.where(~_is_hot(keyed, rows))
    return cold.hint("shuffle_hash") if keys <= HASH_KEYS * partitions(keyed) else cold


def hot_keys(keyed: DataFrame, rows: int, tasks: int | None = None) -> DataFrame:
    """Keys with so many of the ``rows`` rows that one of the ``tasks`` should not get them all.

    There are as many tasks as shuffle partitions if nothing else is said.
    """
    return keyed.where(_is_hot(keyed, rows, tasks))


def attach(big: DataFrame, keyed: DataFrame, key: str, rows: int) -> DataFrame:
    """Inner join of ``big`` with the unique keys of ``keyed``, safe for hot keys.

    ``keyed``, a written table, carries ``degree``: the number of the ``rows``
    rows of ``big`` with that key. Few keys are broadcast. Otherwise rows of
    hot keys meet a broadcast of the hot keys and never move, and the rest is
    an ordinary join in which no key weighs down a partition.
    """
    keys = keyed.count()
    if keys <= BROADCAST_KEYS:
        return big.join(F.broadcast(keyed), key)
    big = durable(big, "to-join")  # both parts read it
    hot, cold = hot_keys(keyed, rows), _cold_keys(keyed, rows, keys)
    hot_rows = big.join(F.broadcast(hot), key)
    cold_rows = big.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return hot_rows.unionByName(cold_rows)


def without(big: DataFrame, keyed: DataFrame, key: str, rows: int) -> DataFrame:
    """Rows of ``big`` whose key is not in ``keyed``; the other half of ``attach``.

    For keys that are not in ``keyed`` and are not hot.
    """
    keys, keyed = keyed.count(), keyed.select(key, "degree")
    if keys <= BROADCAST_KEYS:
        return big.join(F.broadcast(keyed.select(key)), key, "left_anti")
    hot, cold = hot_keys(keyed, rows), _cold_keys(keyed, rows, keys)
    return big.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, "left_anti")
