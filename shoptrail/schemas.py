"""Schemas of the datasets the jobs hand to each other."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

BEHAVIOR_LOG = StructType(
    [
        StructField("user_id", StringType()),
        StructField("item_id", StringType()),
        StructField("category_id", StringType()),
        StructField("behavior", StringType()),
        StructField("ts", LongType()),
    ]
)

REJECTED_LINES = StructType(
    [
        StructField("line", StringType()),
        StructField("reason", StringType()),
        StructField("behavior", StringType()),
    ]
)

USER_STATS = StructType(
    [
        StructField("user_id", StringType()),
        StructField("last_ts", LongType()),
        StructField("event_count", LongType()),
        StructField("score", LongType()),
    ]
)

USER_FEATURES = StructType(
    [
        StructField("user_id", StringType()),
        StructField("f1", DoubleType()),
        StructField("f2", DoubleType()),
        StructField("f3", DoubleType()),
    ]
)

USER_ITEM_PAIRS = StructType(
    [StructField("user_id", StringType()), StructField("item_id", StringType())]
)

ITEM_USER_INDEX = StructType(
    [
        StructField("item_id", StringType()),
        StructField("block", LongType()),
        StructField("users", ArrayType(StringType())),
    ]
)

ITEM_CO_OCCURRENCE = StructType(
    [
        StructField("item_a", StringType()),
        StructField("item_b", StringType()),
        StructField("cnt", LongType()),
    ]
)

CLUSTER_CENTERS = StructType(
    [
        StructField("cluster", IntegerType()),
        StructField("c1", DoubleType()),
        StructField("c2", DoubleType()),
        StructField("c3", DoubleType()),
    ]
)

RECOMMENDATIONS = StructType(
    [
        StructField("rank", IntegerType()),
        StructField("item_id", StringType()),
        StructField("score", DoubleType()),
    ]
)
