"""Distributed numbering of sorted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.functions.text import id_order
from shoptrail.sources.durable import durable

# monotonically_increasing_id: partition number above, row number below.
_ROW_BITS = 33


def with_position(df: DataFrame, key: str) -> DataFrame:
    """``df`` (unique in ``key``) with ``position`` 0, 1, 2 ... in id order."""
    return numbered(df, id_order(F.col(key)))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``position`` 0, 1, 2 ... in an ``order`` without ties.

    A range sort numbers the rows inside each partition; the partitions'
    sizes, one row each, turn that into positions in the whole. No partition
    sees more than its own range.
    """
    ranged = durable(
        df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()),
        "positions",
    )
    split = ranged.withColumn("_part", F.shiftright("_id", _ROW_BITS)).withColumn(
        "_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    sizes = split.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    # One row per sort partition, so this window is small by construction.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset")
    )
    return split.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_row")).alias("position")
    )
