"""Personalised rank: a random walk with restart from one user.

With restart chance ``1 - alpha`` at the target, round ``t`` of the usual
iteration equals

    r(t) = (1 - alpha) * sum_{s<t} alpha^s x(s)  +  alpha^t x(t)

where ``x(s)`` is the plain walk without restart after ``s`` steps. The plain
walk is on users after an even and on items after an odd number of steps, so
each round reads the links in one direction only. Also

    max |r(t) - r(t-1)| = alpha^t * max(max x(t), max x(t-1))

because ``x(t)`` and ``x(t-1)`` share no node: the stopping test needs no join.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shoptrail.constants import (
    ITEM,
    TOP_RECOMMENDATIONS,
    USER,
    WALK_ALPHA,
    WALK_MAX_ITER,
    WALK_TOL,
)
from shoptrail.functions.numbers import twelve_digits
from shoptrail.functions.text import id_order
from shoptrail.operators.graph import Graph, build_graph
from shoptrail.operators.pairs import BROADCAST_KEYS
from shoptrail.operators.positions import numbered
from shoptrail.sources.durable import new_path

# The walk's vector is broadcast up to this many rows (two numbers each).
BROADCAST_ROWS = 200_000
# Links of one node kept together; a node with more is split over partitions.
SPLIT_LINKS = 1_000_000
# A bucket's part of the vector is hashed up to this many rows, else sorted.
HASH_ROWS = 2_000_000
_VECTOR = "node bigint, x double"


@dataclass
class Walk:
    """Vectors ``x(0) .. x(rounds)``, one folder ``round=s`` each; later ones do not count."""

    graph: Graph
    target: str
    path: str
    rounds: int
    alpha: float

    def ranks(self, kind: str) -> DataFrame:
        """``(node, score)`` of the users or of the items the walk reached."""
        spark = self.graph.links.sparkSession
        s = F.col("round")
        weight = F.pow(F.lit(self.alpha), s) * F.when(s == self.rounds, 1.0).otherwise(
            1.0 - self.alpha
        )
        # Only the folders of that side are read.
        vectors = spark.read.schema(f"{_VECTOR}, round int").parquet(self.path)
        side = vectors.where((s % 2 == (0 if kind == USER else 1)) & (s <= self.rounds))
        return side.groupBy("node").agg(F.sum(F.col("x") * weight).alias("score"))

    def own_items(self) -> DataFrame:
        """Numbers of the target's own items: the nodes after one step."""
        graph, spark = self.graph, self.graph.links.sparkSession
        if self.rounds == 0:
            target = graph.users.where(F.col("user_id") == self.target).select("user")
            return graph.links.join(F.broadcast(target), "user", "left_semi").select("item")
        vectors = spark.read.schema(f"{_VECTOR}, round int").parquet(self.path)
        return vectors.where("round = 1").select(F.col("node").alias("item"))


class _Side:
    """The links leaving one kind of node, laid out for repeated joins."""

    def __init__(self, graph: Graph, kind: str, broadcast_rows: int, split_links: int):
        src, dst, nodes = (
            (USER, ITEM, graph.users) if kind == USER else (ITEM, USER, graph.items)
        )
        self.spark = graph.links.sparkSession
        self.links = graph.links.select(
            F.col(src).alias("src"), F.col(f"{src}_degree").alias("degree"), F.col(dst).alias("dst")
        )
        self.broadcast_rows = broadcast_rows
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.parts = F.ceil(F.col("degree") / split_links).cast("int")
        # Nodes with more links than that: at most links / split_links of them.
        self.large = nodes.where(F.col("degree") > split_links).select(
            F.col(src).alias("src"), self.parts.alias("parts")
        )
        self.table: str | None = None

    def _write_buckets(self) -> None:
        """The links as a table bucketed by source.

        Every later round joins it without moving it. The links of a node with
        very many are in several buckets, chosen by the other end.
        """
        links, self.keys = self.links, ["src"]
        self.large_count = self.large.count()
        if self.large_count:
            self.keys = ["src", "part"]
            links = links.withColumn("part", F.pmod(F.hash("dst"), self.parts))
        table = f"shoptrail_links_{uuid.uuid4().hex}"
        (
            links.repartition(self.buckets, *self.keys)
            .write.bucketBy(self.buckets, *self.keys)
            .option("path", new_path(self.spark, "links"))
            .saveAsTable(table)
        )
        self.table = table

    def _spread(self, vector: DataFrame) -> DataFrame:
        """The vector with one row per part of a node that is in several buckets."""
        if not self.large_count:
            return vector
        large = F.broadcast(self.large) if self.large_count <= BROADCAST_KEYS else self.large
        every = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
        return vector.join(large, "src", "left").select("src", "x", F.explode(every).alias("part"))

    def step(self, vector: DataFrame, rows: int) -> DataFrame:
        """The vector after one more step, on the other kind of node."""
        vector = vector.withColumnRenamed("node", "src")
        if rows <= self.broadcast_rows:
            met = self.links.join(F.broadcast(vector), "src")
        else:
            if self.table is None:
                self._write_buckets()
            spread = self._spread(vector)
            if rows <= HASH_ROWS * self.buckets:
                # The vector is the small side of a bucket; links need no sort.
                spread = spread.hint("shuffle_hash")
            met = self.spark.table(self.table).join(spread, self.keys)
        # Shares of a node with very many links add up before the shuffle.
        return met.groupBy(F.col("dst").alias("node")).agg(
            F.sum(F.col("x") / F.col("degree")).alias("x")
        )

    def close(self) -> None:
        if self.table is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _write_rounds(spark: SparkSession, vectors: list[DataFrame], path: str, s: int):
    """Write ``x(s)`` and those after it in one job.

    Returns the last one, with its number of rows, and the largest value of each.
    """
    every = range(s, s + len(vectors))
    tagged = [v.withColumn("round", F.lit(r)) for r, v in zip(every, vectors, strict=True)]
    peak = [F.max(F.when(F.col("round") == r, F.col("x"))).alias(f"peak{r}") for r in every]
    rows = F.count_if(F.col("round") == every[-1]).alias("rows")
    seen = Observation()
    union = reduce(DataFrame.unionByName, tagged).observe(seen, rows, *peak)
    union.write.mode("append").partitionBy("round").parquet(path)
    found = seen.get
    last = spark.read.schema(_VECTOR).parquet(f"{path}/round={every[-1]}") if found["rows"] else None
    if last is None:  # no folder for no rows
        last = spark.createDataFrame([], _VECTOR)
    return last, found["rows"], [found[f"peak{r}"] or 0.0 for r in every]


def walk_from(
    graph: Graph,
    target: str,
    alpha: float = WALK_ALPHA,
    max_iter: int = WALK_MAX_ITER,
    tol: float = WALK_TOL,
    broadcast_rows: int = BROADCAST_ROWS,
    split_links: int = SPLIT_LINKS,
) -> Walk:
    """Walk until no rank moves by more than ``tol``, at most ``max_iter`` rounds."""
    spark = graph.links.sparkSession
    path = new_path(spark, "walk")
    sides = [_Side(graph, kind, broadcast_rows, split_links) for kind in (USER, ITEM)]
    start = graph.users.where(F.col("user_id") == target).select(
        F.col("user").alias("node"), F.lit(1.0).alias("x")
    )
    # Where no vector is too long to broadcast, two steps make one job.
    at_once = 2 if max(graph.users.count(), graph.items.count()) <= broadcast_rows else 1
    try:
        vector, rows, peaks = _write_rounds(spark, [start], path, 0)
        rounds, moved = 0, math.inf
        while rounds < max_iter and moved > tol:
            stepped = [vector]
            for s in range(rounds, min(max_iter, rounds + at_once)):
                stepped.append(sides[s % 2].step(stepped[-1], rows))
            last = peaks[-1]
            vector, rows, peaks = _write_rounds(spark, stepped[1:], path, rounds + 1)
            for peak in peaks:
                if moved > tol:
                    rounds += 1
                    moved = alpha**rounds * max(peak, last)
                    last = peak
    finally:
        for side in sides:
            side.close()
    return Walk(graph, target, path, rounds, alpha)


def _item_scores(walk: Walk, include_unreached: bool) -> DataFrame:
    how = "left" if include_unreached else "inner"
    return (
        walk.graph.items.join(walk.ranks(ITEM).withColumnRenamed("node", "item"), "item", how)
        .select("item", "item_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    )


def rank_scores(
    pairs: DataFrame, target: str, include_unreached: bool = False, **walk_options
) -> DataFrame:
    """Rank of every node: ``(kind, id, score)``.

    ``include_unreached`` adds the nodes no walk reaches, with score 0. A
    target that is no node keeps only its own restart chance.
    """
    return graph_scores(build_graph(pairs), target, include_unreached, **walk_options)


def graph_scores(
    graph: Graph, target: str, include_unreached: bool = False, **walk_options
) -> DataFrame:
    """``rank_scores`` on a graph that is built already."""
    walk = walk_from(graph, target, **walk_options)
    users = graph.users.join(
        walk.ranks(USER).withColumnRenamed("node", "user"),
        "user",
        "left" if include_unreached else "inner",
    ).select(
        F.lit(USER).alias("kind"),
        F.col("user_id").alias("id"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
    items = _item_scores(walk, include_unreached).select(
        F.lit(ITEM).alias("kind"), F.col("item_id").alias("id"), "score"
    )
    known = graph.users.where(F.col("user_id") == target).select("user_id")
    lonely = graph.links.sparkSession.range(1).select(
        F.lit(USER).alias("kind"),
        F.lit(target).alias("id"),
        F.lit(1.0 - walk.alpha if walk.rounds else 1.0).alias("score"),
    )
    lonely = lonely.join(known, lonely["id"] == known["user_id"], "left_anti")
    return users.unionByName(items).unionByName(lonely)


def personal_rank(
    pairs: DataFrame,
    target: str,
    top: int = TOP_RECOMMENDATIONS,
    include_unreached: bool = False,
    **walk_options,
) -> DataFrame:
    """The ``top`` items the target does not have yet: ``(rank, item_id, score)``.

    Equal scores rank by id. An unknown target has no recommendation unless
    ``include_unreached`` fills the list with items of score 0.
    """
    return best_items(build_graph(pairs), target, top, include_unreached, **walk_options)


def best_items(
    graph: Graph,
    target: str,
    top: int = TOP_RECOMMENDATIONS,
    include_unreached: bool = False,
    **walk_options,
) -> DataFrame:
    """``personal_rank`` on a graph that is built already, for one target after another."""
    walk = walk_from(graph, target, **walk_options)
    # Beyond twelve digits scores differ by the order of adding alone.
    order = [twelve_digits(F.col("score")).desc(), id_order(F.col("item_id")).asc()]
    best = (
        _item_scores(walk, include_unreached)
        .join(walk.own_items(), "item", "left_anti")
        .orderBy(*order)
        .limit(top)
    )
    if top > BROADCAST_KEYS:  # more than one task should number
        ranked = numbered(best, *order)
        return ranked.select(
            (F.col("position") + 1).cast("int").alias("rank"), "item_id", "score"
        )
    rank = F.row_number().over(Window.orderBy(*order)).alias("rank")
    return best.select(rank, "item_id", "score")
