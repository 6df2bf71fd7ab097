"""Text inputs. A line is one row; quotes have no meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shoptrail.constants import FEATURE_FIELDS, FEATURE_HEADER_PREFIX
from shoptrail.functions.text import as_double, strip
from shoptrail.sources.durable import durable


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Any path or glob Spark reads, as one string column ``value``."""
    return spark.read.text(path)


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a written export with their ``position``, 0 upwards, in the order of its files.

    Part files follow each other by name. A file may be read in several blocks:
    a table of one row per block turns a line's place in its block into its
    place in the export, so no task sees more than its own blocks.
    """
    file, block = "_metadata.file_name", "_metadata.file_block_start"
    lines = spark.read.text(path).select(
        "value",
        F.col(file).alias("file"),
        F.col(block).alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    lines = durable(lines, "export-lines")
    blocks = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first")
    )
    # One row per block of a file.
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "file",
        "block",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    return lines.join(F.broadcast(starts), ["file", "block"]).select(
        (F.col("id") + F.col("shift")).alias("position"), "value"
    )


def judge_feature_lines(lines: DataFrame) -> DataFrame:
    """Fields of each line, and ``reason`` why it is no feature row (null if it is)."""
    split = lines.select(strip(F.col("value")).alias("line")).select(
        "line", F.split("line", ",", -1).alias("parts")
    )
    fields = split.select(
        "line",
        F.size("parts").alias("field_count"),
        strip(F.get("parts", F.lit(0))).alias("user_id"),
        *[as_double(strip(F.get("parts", F.lit(i)))).alias(f"f{i}") for i in (1, 2, 3)],
    )
    no_number = F.col("f1").isNull() | F.col("f2").isNull() | F.col("f3").isNull()
    reason = (
        F.when(F.col("line").isNull() | (F.col("line") == ""), "empty line")
        .when(F.col("line").startswith(FEATURE_HEADER_PREFIX), "header")
        .when(F.col("field_count") < FEATURE_FIELDS, "too few fields")
        .when(F.col("user_id") == "", "blank user")
        .when(no_number, "not a finite number")
    )
    return fields.withColumn("reason", reason)


def parse_feature_lines(lines: DataFrame, observation: Observation | None = None) -> DataFrame:
    """``user,f1,f2,f3`` lines as typed rows.

    Header, short lines, blank users and values that are not finite numbers
    are dropped. An ``observation`` receives the counts ``lines`` and ``kept``.
    """
    judged = judge_feature_lines(lines)
    kept = F.col("reason").isNull()
    if observation is not None:
        judged = judged.observe(
            observation, F.count(F.lit(1)).alias("lines"), F.count_if(kept).alias("kept")
        )
    # Unnesting zero or one row per line splits the line once; a filter would
    # be pushed below the projection and split it again.
    row = F.struct("user_id", "f1", "f2", "f3")
    return judged.select(F.inline(F.when(kept, F.array(row))))


def feature_verdicts(lines: DataFrame) -> DataFrame:
    """Number of lines per reject reason; feature rows count as ``kept``."""
    return (
        judge_feature_lines(lines)
        .groupBy(F.coalesce("reason", F.lit("kept")).alias("verdict"))
        .agg(F.count(F.lit(1)).alias("line_count"))
    )
