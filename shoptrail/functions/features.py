"""Expressions of the user features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoptrail.constants import BEHAVIOR_WEIGHTS, SECONDS_PER_DAY


def behavior_weight(behavior: Column) -> Column:
    cases = reduce(
        lambda acc, kv: acc.when(behavior == kv[0], F.lit(kv[1])),
        BEHAVIOR_WEIGHTS.items(),
        F,
    )
    return cases.otherwise(F.lit(1)).cast("bigint")


def days_before(ts: Column, newest: Column) -> Column:
    return (newest - ts) / F.lit(SECONDS_PER_DAY)


def min_max(v: Column, low: Column, high: Column) -> Column:
    """``v`` scaled to 0..1; 0 where all values are equal."""
    return F.when(high > low, (v - low) / (high - low)).otherwise(F.lit(0.0))
