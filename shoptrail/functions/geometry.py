"""Distances to cluster centres."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many centres the comparison is unrolled into generated code; with
# twice as many the generated method is too long for the JVM to compile. More
# centres are a table.
UNROLLED = 16


def distance(point: Sequence[Column], centre: Sequence[Column]) -> Column:
    squares = [(p - c) * (p - c) for p, c in zip(point, centre, strict=True)]
    return F.sqrt(sum(squares[1:], squares[0]))


def nearest(point: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """Number of the closest centre; the lowest number wins a tie.

    A struct compares field by field, so the smallest (distance, number) pair
    is the answer. ``centres``, ``UNROLLED`` at most, travel as literals.
    """
    if len(centres) == 1:
        return F.lit(0)
    candidates = [
        F.struct(
            distance(point, [F.lit(float(v)) for v in c]).alias("d"),
            F.lit(i).alias("cluster"),
        )
        for i, c in enumerate(centres)
    ]
    return F.least(*candidates)["cluster"]


def nearest_in_table(point: Sequence[Column], table: Column, axes: Sequence[str]) -> Column:
    """The same with centres as one array of structs, ``cluster`` and the ``axes``."""
    scored = F.transform(
        table,
        lambda c: F.struct(
            distance(point, [c[a] for a in axes]).alias("d"), c["cluster"].alias("cluster")
        ),
    )
    return F.array_min(scored)["cluster"]


def two_nearest_in_table(point: Sequence[Column], table: Column, axes: Sequence[str]) -> Column:
    """The same as ``(cluster, near, far)``, with the distances of it and of the next one."""
    far = F.lit(float("inf"))

    def closer(best: Column, c: Column) -> Column:
        d = distance(point, [c[a] for a in axes])
        first = F.struct(c["cluster"].alias("cluster"), d.alias("near"), best["near"].alias("far"))
        second = F.struct(best["cluster"], best["near"], F.least(best["far"], d).alias("far"))
        return F.when(d < best["near"], first).otherwise(second)

    none = F.struct(F.lit(0).alias("cluster"), far.alias("near"), far.alias("far"))
    return F.aggregate(table, none, closer)
