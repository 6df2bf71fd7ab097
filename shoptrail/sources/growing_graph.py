"""A user-item graph whose nodes keep their numbers while it grows.

A folder holds, in parts, the numbers of users, of items, and the links between
numbers. A part only adds: new ids are numbered after the old ones, and links
of old nodes stay as they are.

One writer at a time. A part that was not finished is written again by the
next call with the same pairs, which adds what is still missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.constants import ITEM, USER
from shoptrail.operators.graph import Graph
from shoptrail.operators.pairs import attach, degrees, written_pairs
from shoptrail.operators.positions import with_position
from shoptrail.sources.durable import durable

_LINKS = "user long, item long, part int"


def start_graph(pairs: DataFrame, path: str) -> None:
    """Make a graph of distinct ``pairs``, or replace the one that is there."""
    spark, none = pairs.sparkSession, "part int"
    for kind in (USER, ITEM):
        empty = spark.createDataFrame([], f"{kind}_id string, {kind} long, {none}")
        empty.write.mode("overwrite").partitionBy("part").parquet(f"{path}/{kind}")
    empty = spark.createDataFrame([], _LINKS)
    empty.write.mode("overwrite").partitionBy("part").parquet(f"{path}/link")
    add_links(pairs, path)


def add_links(pairs: DataFrame, path: str) -> None:
    """Add distinct ``pairs``, of which some may be in the graph already.

    Old ids are read to tell which are new, and old links only where both ends
    of a pair are old.
    """
    pairs = written_pairs(pairs)
    spark, rows = pairs.sparkSession, pairs.count()
    users = durable(_number(pairs, path, USER), "user-numbers")
    items = durable(_number(pairs, path, ITEM), "item-numbers")
    by_user = attach(pairs, users, "user_id", rows).select(
        "item_id", "user", F.col("old").alias("old_user")
    )
    both = attach(by_user, items, "item_id", rows).select(
        "user", "item", (F.col("old") & F.col("old_user")).alias("old")
    )
    both = durable(both, "numbered-pairs")
    links = spark.read.schema(_LINKS).parquet(f"{path}/link")
    known = both.where("old").join(links.select("user", "item"), ["user", "item"], "left_anti")
    new = both.where("NOT old").unionByName(known).select("user", "item")
    _append(new, f"{path}/link", _LINKS)


def read_graph(spark: SparkSession, path: str) -> Graph:
    """The graph as ``build_graph`` gives it for all pairs at once, but for the numbers."""
    links = spark.read.schema(_LINKS).parquet(f"{path}/link").select("user", "item")
    rows = links.count()
    # Both are written, as the links join them and walks read them again.
    users, items = (
        durable(
            _numbers(spark, path, kind).join(degrees(links, kind), kind).select(
                f"{kind}_id", "degree", kind
            ),
            f"{kind}s",
        )
        for kind in (USER, ITEM)
    )
    by_user = attach(links, users, USER, rows).withColumnRenamed("degree", "user_degree")
    ends = attach(by_user, items, ITEM, rows).withColumnRenamed("degree", "item_degree")
    ends = ends.select("user", "user_degree", "item", "item_degree")
    return Graph(users, items, durable(ends, "links"))


def _numbers(spark: SparkSession, path: str, kind: str) -> DataFrame:
    schema = f"{kind}_id string, {kind} long, part int"
    return spark.read.schema(schema).parquet(f"{path}/{kind}").select(f"{kind}_id", kind)


def _number(pairs: DataFrame, path: str, kind: str) -> DataFrame:
    """Ids of ``pairs`` with degree, number, and whether they are old; new ones are added."""
    spark, key = pairs.sparkSession, f"{kind}_id"
    known = _numbers(spark, path, kind)
    last = known.agg(F.max(kind)).first()[0]
    # Read before the new part is written.
    found = durable(degrees(pairs, key).join(known, key, "left"), f"{kind}-found")
    fresh = with_position(found.where(F.col(kind).isNull()).select(key), key)
    start = F.lit(0 if last is None else last + 1)
    fresh = durable(fresh.select(key, (F.col("position") + start).alias(kind)), f"new-{kind}s")
    _append(fresh, f"{path}/{kind}", f"{key} string, {kind} long, part int")
    old = found.where(F.col(kind).isNotNull()).withColumn("old", F.lit(True))
    new = found.drop(kind).join(fresh, key).withColumn("old", F.lit(False))
    return old.unionByName(new)


def _append(df: DataFrame, path: str, schema: str) -> None:
    last = df.sparkSession.read.schema(schema).parquet(path).agg(F.max("part")).first()[0]
    part = 0 if last is None else last + 1
    df.write.mode("overwrite").parquet(f"{path}/part={part}")
