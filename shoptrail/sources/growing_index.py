"""An inverted index that takes new pairs without being built anew.

A folder holds generations of blocks ``(item_id, low, users)``: sorted users of
an item from ``low``, the lowest one when the block was made, up to the next
block's; the first block of an item has no ``low``. New pairs write a
generation with the blocks that get users, and the newest block of an item and
``low`` counts. A block only grows or is cut, so whatever was in it is in the
newer blocks, and adding the same pairs again changes nothing.

One writer at a time: a generation is read by the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoptrail.functions.text import id_order
from shoptrail.operators.index import BLOCK_USERS, item_user_index
from shoptrail.sources.durable import durable

_BLOCK = "item_id string, low string, users array<string>, generation int"


def write_index(pairs: DataFrame, path: str, block_users: int = BLOCK_USERS) -> None:
    """Make an index of distinct ``pairs``, or replace the one that is there."""
    _with_low(item_user_index(pairs, block_users)).withColumn(
        "generation", F.lit(0)
    ).write.mode("overwrite").partitionBy("generation").parquet(path)


def add_pairs(pairs: DataFrame, path: str, block_users: int = BLOCK_USERS) -> None:
    """Add distinct ``pairs``, of which some may be in the index already.

    The new pairs are cut into blocks first. Then a block of the index meets at
    most ``block_users`` new users between two bounds, old or new, however many
    users an item gets at once. A block is compared with the bounds inside it
    and with no others, so the work grows with the users and the bounds of an
    item and not with their product. Blocks without new users are neither
    shuffled nor written.
    """
    spark = pairs.sparkSession
    index = _live(spark, path)
    new = durable(_with_low(item_user_index(pairs, block_users)), "new-blocks")
    lows = index.select("item_id", "low").join(
        new.select("item_id").distinct(), "item_id", "left_semi"
    )
    bounds = durable(_bounds(lows, new.select("item_id", "low")), "bounds")
    into_new = _inside(bounds, "new")
    # The block that the first users of a new block go to.
    homes = bounds.where("is_new").select("item_id", "low", F.col("old.low").alias("first_home"))
    within = F.col("within")
    routed = (
        _at_block(_at_block(new, homes), into_new)
        .select("item_id", "low", "first_home", F.explode("users").alias("user_id"), "inside")
        .select("*", _last_bound("inside").alias("within"))
        .select(
            "item_id",
            "user_id",
            F.coalesce(within, "first_home").alias("home"),
            F.coalesce(within, "low").alias("low"),
        )
    )
    routed = durable(routed, "new-users")
    touched = routed.select("item_id", F.col("home").alias("low")).distinct()
    old = (
        _at_block(_at_block(index, touched, "left_semi"), _inside(bounds, "old"))
        .select("item_id", "low", F.explode("users").alias("user_id"), "inside")
        .select("item_id", "user_id", F.coalesce(_last_bound("inside"), "low").alias("low"))
    )
    merged = (
        old.unionByName(routed.select("item_id", "user_id", "low"))
        .groupBy("item_id", "low")
        .agg(F.collect_set("user_id").alias("users"))
    )
    last = spark.read.schema(_BLOCK).parquet(path).agg(F.max("generation")).first()[0]
    generation = 0 if last is None else last + 1
    _cut(merged, block_users).write.mode("overwrite").parquet(f"{path}/generation={generation}")


def read_index(spark: SparkSession, path: str, block_users: int = BLOCK_USERS) -> DataFrame:
    """``(item_id, block, users)`` as ``item_user_index`` gives them for all pairs at once.

    Stored blocks are in order, so users are cut anew by counting and not by sorting.
    """
    # A row per block, so an item has as many as its users ask for.
    item = Window.partitionBy("item_id")
    before = item.orderBy(F.col("low").isNotNull(), id_order(F.col("low"))).rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.coalesce(F.sum(F.size("users")).over(before), F.lit(0)).cast("bigint")
    first, last = (
        F.floor(at / block_users).cast("bigint")
        for at in (F.col("start"), F.col("start") + F.size("users") - 1)
    )
    # What of a stored block belongs to a block of the result.
    skip = F.greatest(F.lit(0), F.col("block") * block_users - F.col("start")).cast("int")
    until = F.least(F.size("users"), (F.col("block") + 1) * block_users - F.col("start"))
    piece = F.struct("start", F.slice("users", skip + 1, until.cast("int") - skip).alias("users"))
    return (
        _live(spark, path)
        .withColumn("start", start)
        .withColumn("block", F.explode(F.sequence(first, last)))
        .groupBy("item_id", "block")
        .agg(F.sort_array(F.collect_list(piece)).alias("parts"))
        .select("item_id", "block", F.flatten("parts.users").alias("users"))
    )


def _live(spark: SparkSession, path: str) -> DataFrame:
    """The newest block of each item and ``low``."""
    table = spark.read.schema(_BLOCK).parquet(path)
    newer = (
        table.groupBy("item_id", "low")
        .agg(F.max("generation").alias("newest"), F.count(F.lit(1)).alias("written"))
        .where("written > 1")
        .alias("n")
    )
    stale = (
        (F.col("b.item_id") == F.col("n.item_id"))
        & F.col("b.low").eqNullSafe(F.col("n.low"))
        & (F.col("b.generation") < F.col("n.newest"))
    )
    return table.alias("b").join(newer, stale, "left_anti").select("item_id", "low", "users")


def _with_low(index: DataFrame) -> DataFrame:
    low = F.when(F.col("block") > 0, F.get("users", F.lit(0)))
    return index.select("item_id", low.alias("low"), "users")


def _bounds(old: DataFrame, new: DataFrame) -> DataFrame:
    """Where blocks begin: ``(item_id, low, is_old, is_new, old, new)``.

    ``old`` and ``new`` hold the ``low`` of the old and the new block that the
    bound is in or begins; they are null for items without such blocks.
    """
    both = old.withColumn("is_old", F.lit(True)).unionByName(
        new.withColumn("is_old", F.lit(False))
    )
    marks = both.groupBy("item_id", "low").agg(
        F.bool_or("is_old").alias("is_old"), F.bool_or(~F.col("is_old")).alias("is_new")
    )
    # A row per block, as in ``read_index``.
    until = (
        Window.partitionBy("item_id")
        .orderBy(F.col("low").isNotNull(), id_order(F.col("low")))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # In a structure the missing bound of a first block is no null.
    found = {
        name: F.last(F.when(F.col(f"is_{name}"), F.struct("low")), ignorenulls=True).over(until)
        for name in ("old", "new")
    }
    return marks.withColumns(found)


def _inside(bounds: DataFrame, name: str) -> DataFrame:
    """Bounds of the others strictly inside the ``name`` blocks: ``(item_id, low, inside)``."""
    return (
        bounds.where(~F.col(f"is_{name}") & F.col(name).isNotNull())
        .groupBy("item_id", F.col(f"{name}.low").alias("low_of"))
        .agg(F.collect_list(id_order(F.col("low"))).alias("inside"))
        .withColumnRenamed("low_of", "low")
    )


def _at_block(blocks: DataFrame, more: DataFrame, how: str = "left") -> DataFrame:
    """Join on ``item_id`` and ``low``, which a first block does not have."""
    names = [c for c in more.columns if c not in ("item_id", "low")]
    more = more.withColumnsRenamed({"item_id": "_item", "low": "_low"})
    same = (F.col("item_id") == F.col("_item")) & F.col("low").eqNullSafe(F.col("_low"))
    joined = blocks.join(more, same, how)
    return joined if how == "left_semi" else joined.select(*blocks.columns, *names)


def _last_bound(bounds: str) -> Column:
    """The last of the ``bounds`` up to ``user_id``; null where it comes before them."""
    user = id_order(F.col("user_id"))
    return F.array_max(F.filter(bounds, lambda low: low <= user))["id"]


def _cut(merged: DataFrame, block_users: int) -> DataFrame:
    """Blocks of unsorted users as sorted ones of at most ``block_users``, about equal."""
    ordered = F.sort_array(F.transform("users", id_order))["id"]
    parts = F.ceil(F.size("users") / block_users)
    size = F.ceil(F.size("users") / parts).cast("int")
    begins = F.sequence(F.lit(0), F.size("users") - 1, size)
    return (
        merged.withColumn("users", ordered)
        .select("*", size.alias("size"), F.explode(begins).alias("begin"))
        .select(
            "item_id",
            F.when(F.col("begin") == 0, F.col("low"))
            .otherwise(F.get("users", F.col("begin")))
            .alias("low"),
            F.slice("users", F.col("begin") + 1, F.col("size")).alias("users"),
        )
    )
