"""Row counts of the datasets, as quality figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.constants import USER
from shoptrail.operators.clusters import all_finite
from shoptrail.operators.features import user_stats
from shoptrail.operators.graph import graph_nodes


def _figures(**columns: Column) -> Column:
    rows = [
        F.struct(F.lit(name).alias("metric"), F.coalesce(c, F.lit(0)).alias("row_count"))
        for name, c in columns.items()
    ]
    return F.inline(F.array(*rows))


def log_counts(log: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(metric, row_count)``: records, users, pairs, graph edges and nodes.

    Both parts read per-key tables that combined on the map side; a pair is
    one link of its user and two directed edges.
    """
    users = user_stats(log).agg(
        F.sum("event_count").alias("records"), F.count(F.lit(1)).alias("users")
    )
    nodes = graph_nodes(pairs).agg(
        F.sum(F.when(F.col("kind") == USER, F.col("degree"))).alias("pairs"),
        F.sum("degree").alias("edges"),
        F.count(F.lit(1)).alias("nodes"),
    )
    of_log = users.select(_figures(records=F.col("records"), users=F.col("users")))
    of_graph = nodes.select(
        _figures(pairs=F.col("pairs"), edges=F.col("edges"), nodes=F.col("nodes"))
    )
    return of_log.unionByName(of_graph)


def record_verdicts(log: DataFrame) -> DataFrame:
    """Number of records with all their ids, and of those without, by the first missing."""
    missing = F.lit(None)
    for name in ("category_id", "item_id", "user_id"):
        missing = F.when(F.col(name).isNull(), f"no {name}").otherwise(missing)
    return log.groupBy(F.coalesce(missing, F.lit("kept")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("line_count")
    )


def feature_row_verdicts(features: DataFrame) -> DataFrame:
    """Number of feature rows that clustering takes, and of those it leaves out."""
    verdict = F.when(all_finite(), "kept").otherwise("not a finite number")
    return features.groupBy(verdict.alias("verdict")).agg(
        F.count(F.lit(1)).alias("line_count")
    )
