"""K-Means over the three user features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from shoptrail.constants import KMEANS_K, KMEANS_MAX_ITER, KMEANS_SEED, KMEANS_TOL
from shoptrail.functions import geometry
from shoptrail.functions.geometry import nearest, nearest_in_table, two_nearest_in_table
from shoptrail.schemas import CLUSTER_CENTERS
from shoptrail.sources.durable import durable

_POINT = ("f1", "f2", "f3")
_CENTER = ("c1", "c2", "c3")
# The most centres, which every task holds: about 32 MB of them.
MAX_CENTERS = 1_000_000
# By this much, as a share, a bound must hold before a comparison is left out.
_SLACK = 1e-9

Centers = list[tuple[float, ...]]


def all_finite() -> Column:
    """Whether all three features are finite numbers; false for null."""
    ok = F.lit(True)
    for c in _POINT:
        ok = ok & F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False))
    return ok


def _finite(features: DataFrame) -> DataFrame:
    return features.where(all_finite()).select("user_id", *_POINT)


def initial_centers(
    features: DataFrame, k: int = KMEANS_K, seed: int = KMEANS_SEED
) -> DataFrame:
    """``k`` users drawn without replacement, as first centres.

    The draw orders users by a hash of seed and id, so it depends on the data
    alone and not on its partitioning.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("user_id")))
    return _finite(features).orderBy(draw, "user_id").limit(k)


def _point() -> list[Column]:
    return [F.col(c) for c in _POINT]


def assign(features: DataFrame, centers: list[tuple[float, ...]]) -> DataFrame:
    """``(user_id, cluster)``: the nearest centre of each user."""
    return _with_nearest(features, centers).select("user_id", "cluster")


def _center_table(spark: SparkSession, centers: list[tuple[float, ...]]) -> DataFrame:
    return spark.createDataFrame([(i, *c) for i, c in enumerate(centers)], CLUSTER_CENTERS)


def _with_nearest(features: DataFrame, centers: list[tuple[float, ...]]) -> DataFrame:
    """``features`` with ``cluster``, the nearest centre.

    Few centres are part of the generated code. More are a table, read as a
    scalar subquery: a row of its own that each task gets, so the plan is the
    same for any number of them and no user moves.
    """
    if len(centers) <= geometry.UNROLLED:
        return features.withColumn("cluster", nearest(_point(), centers))
    row = F.struct("cluster", *_CENTER)
    table = _center_table(features.sparkSession, centers).agg(F.sort_array(F.collect_list(row)))
    cluster = nearest_in_table(_point(), F.col("centers"), _CENTER)
    return features.withColumn("centers", table.scalar()).withColumn("cluster", cluster)


def kmeans_users(
    features: DataFrame,
    k: int = KMEANS_K,
    max_iter: int = KMEANS_MAX_ITER,
    tol: float = KMEANS_TOL,
    seed: int = KMEANS_SEED,
) -> tuple[DataFrame, DataFrame]:
    """Labels ``(user_id, cluster)`` and centres ``(cluster, c1, c2, c3)``.

    Each round is one aggregation to at most ``k`` rows, combined on the map
    side; those rows are all the driver sees. With more than ``UNROLLED``
    clusters users carry bounds, which spare most comparisons. A cluster without users keeps
    its centre. Rows with values that are not finite take no part;
    ``feature_row_verdicts`` counts them.
    """
    if k > MAX_CENTERS:
        raise ValueError(f"at most {MAX_CENTERS} clusters, {k} asked for")
    points = durable(_finite(features), "points")
    first = initial_centers(points, k, seed).collect()
    if len(first) < k:
        raise ValueError(f"{k} clusters need at least {k} users, found {len(first)}")
    centers = [tuple(row[c] for c in _POINT) for row in first]
    rounds = plain_rounds if k <= geometry.UNROLLED else bounded_rounds
    labels, centers, _ = rounds(points, centers, max_iter, tol)
    return labels, _center_table(features.sparkSession, centers)


def _moved(centers: Centers, means: list[Row]) -> tuple[Centers, list[float]]:
    """Centres after a round, and how far each went; one without users stays."""
    moved = list(centers)
    for row in means:
        moved[row["cluster"]] = tuple(row[c] for c in _POINT)
    return moved, [math.dist(a, b) for a, b in zip(centers, moved, strict=True)]


def _means(labelled: DataFrame, *more: Column) -> list[Row]:
    mean = [(F.sum(c) / F.count(F.lit(1))).alias(c) for c in _POINT]
    return labelled.groupBy("cluster").agg(*mean, *more).collect()


def plain_rounds(
    points: DataFrame, centers: Centers, max_iter: int, tol: float
) -> tuple[DataFrame, Centers, list[int]]:
    """Labels, centres, and the users compared with all centres in each round: all of them."""
    compared = []
    for _ in range(max_iter):
        means = _means(_with_nearest(points, centers), F.count(F.lit(1)).alias("users"))
        compared.append(sum(row["users"] for row in means))
        centers, shifts = _moved(centers, means)
        if max(shifts) <= tol:
            break
    return assign(points, centers), centers, compared


def bounded_rounds(
    points: DataFrame, centers: Centers, max_iter: int, tol: float
) -> tuple[DataFrame, Centers, list[int]]:
    """``plain_rounds`` that compare a user only where its nearest centre may have changed.

    Each user carries ``far``, at most its distance to any centre but its own.
    When centres move, it shrinks by the longest way of another one. While the
    distance to the own centre, which is one instead of all, stays below
    ``far``, the label cannot change, nor can there be a tie. The users with
    their bounds are a table per round.
    """
    state = points.withColumns({"cluster": F.lit(0), "far": F.lit(0.0)})
    shifts, compared = [0.0] * len(centers), []
    for _ in range(max_iter):
        state = durable(_bounded(state, centers, shifts), "bounded")
        means = _means(state, F.count_if("compared").alias("compared"))
        compared.append(sum(row["compared"] for row in means))
        centers, shifts = _moved(centers, means)
        if max(shifts) <= tol:
            break
    labels = _bounded(state, centers, shifts).select("user_id", "cluster")
    return labels, centers, compared


def _bounded(state: DataFrame, centers: Centers, shifts: list[float]) -> DataFrame:
    """``state`` with labels and bounds for ``centers``, which moved by ``shifts``."""
    longest = max(range(len(shifts)), key=shifts.__getitem__)
    others = max((s for i, s in enumerate(shifts) if i != longest), default=0.0)
    # Per centre, how far the farthest of the other ones went.
    moves = [others if i == longest else shifts[longest] for i in range(len(shifts))]
    table = state.sparkSession.createDataFrame(
        [(i, *c, m) for i, (c, m) in enumerate(zip(centers, moves, strict=True))],
        "cluster int, c1 double, c2 double, c3 double, others double",
    )
    row = F.struct("cluster", *_CENTER, "others")
    found = state.select("user_id", *_POINT, "cluster", "far").withColumn(
        "centers", table.agg(F.sort_array(F.collect_list(row))).scalar()
    )
    own = F.get("centers", F.col("cluster"))
    near = geometry.distance(_point(), [own[c] for c in _CENTER])
    found = found.withColumns({"near": near, "far": F.col("far") - own["others"]})
    # Rounding errors of the bounds and distances are far smaller than this.
    scale = F.greatest(F.lit(1.0), F.col("near"), *[F.abs(c) for c in _POINT])
    same = F.col("near") + F.lit(_SLACK) * scale < F.col("far")
    nearest_two = two_nearest_in_table(_point(), F.col("centers"), _CENTER)
    kept = F.struct("cluster", "near", "far")
    return (
        found.withColumn("compared", ~same)
        .withColumn("best", F.when(~F.col("compared"), kept).otherwise(nearest_two))
        .select("user_id", *_POINT, "best.cluster", "best.far", "compared")
    )
