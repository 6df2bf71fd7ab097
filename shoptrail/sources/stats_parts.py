"""User statistics of a log that arrives in parts.

A folder holds a table per part of the log: one row per user of the part, not
its events. A part that is written again replaces itself, so a job that failed
half-way or ran twice counts nothing twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from shoptrail.operators.features import merged_stats, user_stats
from shoptrail.schemas import USER_STATS

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def write_part(log: DataFrame, path: str, part: str) -> None:
    """Add the statistics of ``log``, the part named ``part``, or replace that part's."""
    if not _NAME.fullmatch(part):
        raise ValueError(f"no name for a part: {part!r}")
    user_stats(log).write.mode("overwrite").parquet(f"{path}/part={part}")


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Statistics per user over all parts, as ``user_stats`` gives them for the whole log.

    One shuffle of a row per user and part, of which those in a task combine.
    """
    return merged_stats(spark.read.schema(USER_STATS).parquet(path))
