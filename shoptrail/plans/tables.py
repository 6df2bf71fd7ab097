"""The given tables as behaviour logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _epoch_seconds(column: str) -> Column:
    """Whole seconds since 1970 of a zoneless time, whatever the session zone."""
    ts = F.col(column).cast("timestamp_ntz")
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(ts.cast("date")).cast("bigint") * 86400 + clock


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a typed log; event types that are no behaviour drop out."""
    return _log_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def with_ids(log: DataFrame) -> DataFrame:
    """Records that name a user, an item and a category; ``record_verdicts`` counts the rest."""
    return log.where(
        F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("category_id").isNotNull()
    )


def _log_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    item = F.get_json_object("props", "$.k")
    behavior = (
        F.when(kind == "view", "pv")
        .when(kind == "click", "fav")
        .when(kind == "signup", "cart")
        .when(kind == "purchase", "buy")
    )
    return events.where(kind.isin("view", "click", "signup", "purchase")).select(
        F.col("user_id").cast("string").alias("user_id"),
        item.alias("item_id"),
        (item.cast("bigint") % 10).cast("string").alias("category_id"),
        behavior.alias("behavior"),
        _epoch_seconds("ts").alias("ts"),
    )


def keyless_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log in which every seventh event names no item."""
    log = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn(
        "props", F.when(F.col("event_id") % 7 == 0, F.lit("{}")).otherwise(F.col("props"))
    )
    return _log_of(log)


def mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log with number, text and zero-led item ids."""
    n = F.col("item_id").cast("bigint")
    mixed = (
        F.when(n % 3 == 0, F.concat(F.lit("x"), "item_id"))
        .when(n % 3 == 1, F.concat(F.lit("0"), "item_id"))
        .otherwise(F.col("item_id"))
    )
    return events_log(spark, sf_dir).withColumn("item_id", mixed)


def parted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log of two halves: each item once for even and once for odd users."""
    item = F.col("item_id").cast("bigint") * 2 + F.col("user_id").cast("bigint") % 2
    return events_log(spark, sf_dir).withColumn("item_id", item.cast("string"))


def coarse_features(features: DataFrame) -> DataFrame:
    """Features as whole numbers, so that many users coincide."""
    return features.select("user_id", *[F.round(c).alias(c) for c in ("f1", "f2", "f3")])


def catalogue_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse log: one user has all of ``part``, each customer the part of its number."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    item = F.col("p_partkey").cast("string").alias("item_id")
    own = customers.select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.col("c_custkey").cast("string").alias("item_id"),
    )
    return parts.select(F.lit("all").alias("user_id"), item).distinct().unionByName(own.distinct())


def crowded_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many large users in a sparse log: ``catalogue_pairs`` and 24 more users of ``part``.

    Twelve have all parts; of the others each leaves out every n-th part, n from 2.
    """
    user = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("u")
    # Parts are made distinct before they get their users, which differ anyway.
    large = (
        spark.read.parquet(f"{sf_dir}/part.parquet")
        .select("p_partkey")
        .distinct()
        .select("p_partkey", user)
        .where((F.col("u") < 12) | (F.col("p_partkey") % (F.col("u") - 10) != 0))
        .select(
            F.concat(F.lit("large"), F.col("u").cast("string")).alias("user_id"),
            F.col("p_partkey").cast("string").alias("item_id"),
        )
    )
    return catalogue_pairs(spark, sf_dir).unionByName(large)


def purchase_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with ``lineitem`` as a log of what customers do with parts.

    Returned lines are views, lines of old orders favourites or carts, the rest
    purchases.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("l_suppkey").cast("string").alias("category_id"),
        F.when(F.col("l_returnflag") == "R", "pv")
        .when(F.col("l_returnflag") == "A", "fav")
        .when(F.col("l_linenumber") == 1, "cart")
        .otherwise("buy")
        .alias("behavior"),
        _epoch_seconds("o_orderdate").alias("ts"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a raw text line, many of them damaged in some way.

    The damage follows from the event id, so that all cleaning rules meet real
    rows: padding, headers, missing, blank and extra fields, bad times.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_type")
    fields = events.select(
        (F.col("event_id") % 20).alias("damage"),
        F.col("user_id").cast("string").alias("u"),
        F.get_json_object("props", "$.k").alias("i"),
        (F.get_json_object("props", "$.k").cast("bigint") % 10).cast("string").alias("c"),
        F.when(kind == "view", "pv")
        .when(kind == "click", "fav")
        .when(kind == "signup", "cart")
        .when(kind == "purchase", "buy")
        .otherwise(kind)
        .alias("b"),
        _epoch_seconds("ts").cast("string").alias("t"),
    )
    whole = F.concat_ws(",", "u", "i", "c", "b", "t")

    def line(ts: str):
        return F.concat_ws(",", "u", "i", "c", "b", F.lit(ts))

    forms = {
        1: F.concat(F.lit(" "), F.concat_ws(" ,\t", "u", "i", "c", "b", "t"), F.lit("\t ")),
        2: F.lit(""),
        3: F.lit(" \t "),
        4: F.lit("user_id,item_id,category_id,behavior_type,timestamp"),
        5: F.concat(F.lit("USER_ID,"), whole),
        6: F.concat(F.lit("user_id"), whole),
        7: F.concat_ws(",", "u", "i", "c", "b"),
        8: F.concat(whole, F.lit(",extra")),
        9: F.concat(whole, F.lit(",")),
        10: F.concat_ws(",", "u", F.lit(" "), "c", "b", "t"),
        11: F.concat_ws(",", "u", "i", "c", F.upper("b"), "t"),
        12: F.concat_ws(",", "u", "i", "c", F.lit("click"), "t"),
        13: line("abc"),
        14: line("5.7"),
        15: line("1e3"),
        16: line("99999999999999999999"),
        17: F.concat_ws(",", "u", "i", "c", "b", F.concat(F.lit("+"), "t")),
        18: F.concat_ws(",", "u", "i", "c", "b", F.concat(F.lit("-"), "t")),
    }
    value = F
    for damage, text in forms.items():
        value = value.when(F.col("damage") == damage, text)
    return fields.select(value.otherwise(whole).alias("value"))


def feature_text(features: DataFrame) -> DataFrame:
    """Feature rows as text lines, some of them damaged by user id."""
    damage = F.col("user_id").cast("bigint") % 9
    f1, f2, f3 = (F.format_string("%.4f", F.col(c)) for c in ("f1", "f2", "f3"))
    whole = F.concat_ws(",", "user_id", f1, f2, f3)
    value = (
        F.when(damage == 1, F.concat(F.lit(" "), F.concat_ws(" ,\t", "user_id", f1, f2, f3)))
        .when(damage == 2, F.concat(F.lit("user_id,"), whole))
        .when(damage == 3, F.concat_ws(",", "user_id", f1, f2))
        .when(damage == 4, F.concat_ws(",", "user_id", f1, F.lit("abc"), f3))
        .when(damage == 5, F.concat_ws(",", F.lit(" "), f1, f2, f3))
        .when(damage == 6, F.concat_ws(",", "user_id", f1, f2, F.lit("NaN")))
        .when(damage == 7, F.concat(whole, F.lit(",extra")))
        .otherwise(whole)
    )
    return features.select(value.alias("value"))
