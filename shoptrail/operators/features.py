"""Recency, frequency and weighted score per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.features import behavior_weight, days_before, min_max


def global_max_ts(log: DataFrame) -> DataFrame:
    return log.agg(F.max("ts").alias("max_ts"))


def user_stats(log: DataFrame) -> DataFrame:
    """Newest time, number of events and score per user.

    All three combine on the map side, so a user with very many events sends
    one row per task.
    """
    return log.groupBy("user_id").agg(
        F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum(behavior_weight(F.col("behavior"))).alias("score"),
    )


def merged_stats(stats: DataFrame) -> DataFrame:
    """``user_stats`` of a whole log from those of its parts, some rows a user.

    Newest time, count and score of a user are each the maximum or sum of
    those of the parts, so no event is read again.
    """
    return stats.groupBy("user_id").agg(
        F.max("last_ts").alias("last_ts"),
        F.sum("event_count").alias("event_count"),
        F.sum("score").alias("score"),
    )


def _stats_with_extrema(stats: DataFrame) -> DataFrame:
    """Per-user stats, each row with the struct ``e`` of the global extrema.

    The extrema are one row, read as a scalar subquery over the same shuffle:
    the log is scanned once. As a column of its own the subquery stays one.
    """
    extrema = stats.agg(
        F.struct(
            F.min("last_ts").alias("oldest"),
            F.max("last_ts").alias("newest"),
            F.min("event_count").alias("min_count"),
            F.max("event_count").alias("max_count"),
            F.min("score").alias("min_score"),
            F.max("score").alias("max_score"),
        )
    )
    return stats.withColumn("e", extrema.scalar())


def raw_features(log: DataFrame) -> DataFrame:
    """Days since the last event, event count and score, not yet scaled.

    The newest time of the log is the newest of the users' newest times.
    """
    return _stats_with_extrema(user_stats(log)).select(
        "user_id",
        days_before(F.col("last_ts"), F.col("e.newest")).alias("f1"),
        F.col("event_count").cast("double").alias("f2"),
        F.col("score").cast("double").alias("f3"),
    )


def feature_extrema(log: DataFrame) -> DataFrame:
    """One row: smallest and largest raw value of each feature."""
    newest, oldest = F.max("last_ts"), F.min("last_ts")
    return user_stats(log).agg(
        days_before(newest, newest).alias("min_f1"),
        days_before(oldest, newest).alias("max_f1"),
        F.min("event_count").cast("double").alias("min_f2"),
        F.max("event_count").cast("double").alias("max_f2"),
        F.min("score").cast("double").alias("min_f3"),
        F.max("score").cast("double").alias("max_f3"),
    )


def user_features(log: DataFrame, places: int | None = 4) -> DataFrame:
    """The three features, each scaled to 0..1 over all users.

    Rounded to ``places`` decimals, as the feature file stores them; ``None``
    keeps full precision.
    """
    return features_of_stats(user_stats(log), places)


def features_of_stats(stats: DataFrame, places: int | None = 4) -> DataFrame:
    """``user_features`` from ``user_stats``, one row a user."""
    oldest, newest = F.col("e.oldest"), F.col("e.newest")
    scaled = {
        "f1": min_max(
            days_before(F.col("last_ts"), newest),
            days_before(newest, newest),
            days_before(oldest, newest),
        ),
        "f2": min_max(F.col("event_count"), F.col("e.min_count"), F.col("e.max_count")),
        "f3": min_max(F.col("score"), F.col("e.min_score"), F.col("e.max_score")),
    }
    return _stats_with_extrema(stats).select(
        "user_id",
        *[
            (c if places is None else F.round(c, places)).alias(name)
            for name, c in scaled.items()
        ],
    )
