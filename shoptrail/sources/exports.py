"""Text forms of the results, and their writers.

Each function returns one string column ``value``, a line per row. Writers
make a folder of part files in parallel; nothing is merged on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.text import fixed, id_order
from shoptrail.session import settings

# Decimals of features and centres, and of scores.
FEATURE_PLACES = 4
SCORE_PLACES = 3


def log_lines(log: DataFrame) -> DataFrame:
    return log.select(
        F.concat_ws(",", "user_id", "item_id", "category_id", "behavior", "ts").alias("value")
    )


def feature_lines(features: DataFrame) -> DataFrame:
    values = [fixed(F.col(c), FEATURE_PLACES) for c in ("f1", "f2", "f3")]
    return features.select(F.concat_ws(",", "user_id", *values).alias("value"))


def index_lines(index: DataFrame) -> DataFrame:
    """``item<tab>block<tab>users`` lines, sorted by item and block."""
    block = F.col("block").cast("string")
    return index.orderBy("item_id", "block").select(
        F.concat_ws("\t", "item_id", block, F.array_join("users", ",")).alias("value")
    )


def co_occurrence_lines(pairs: DataFrame) -> DataFrame:
    ranked = pairs.orderBy(
        F.desc("cnt"), id_order(F.col("item_a")), id_order(F.col("item_b"))
    )
    return ranked.select(
        F.concat_ws("\t", F.concat_ws(",", "item_a", "item_b"), F.col("cnt").cast("string")).alias(
            "value"
        )
    )


def label_lines(labels: DataFrame) -> DataFrame:
    return labels.orderBy("user_id").select(
        F.concat_ws(",", "user_id", F.col("cluster").cast("string")).alias("value")
    )


def center_lines(centers: DataFrame) -> DataFrame:
    values = [fixed(F.col(c), FEATURE_PLACES) for c in ("c1", "c2", "c3")]
    return centers.orderBy("cluster").select(
        F.concat_ws("\t", F.col("cluster").cast("string"), F.concat_ws(",", *values)).alias("value")
    )


def recommendation_line(best: DataFrame, target: str) -> DataFrame:
    """One line for the target, also where nothing is recommended."""
    entry = F.struct(
        "rank", F.concat_ws(":", "item_id", fixed(F.col("score"), SCORE_PLACES)).alias("text")
    )
    # ``best`` is the top list, so the collected array is short.
    entries = best.agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    listed = F.array_join(F.transform("entries", lambda e: e["text"]), ",")
    return entries.select(F.concat_ws("\t", F.lit(target), listed).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


# Folders a task writes side by side; with fewer open files it would sort first.
OPEN_FOLDERS = 8


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """A table, with a folder per value of ``partition_by``: few values, no sort."""
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FOLDERS}):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
