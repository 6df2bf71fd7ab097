import random

import pytest
from given import TESTDATA
from pyspark.sql import functions as F

from shoptrail.functions import geometry
from shoptrail.operators.clusters import (
    assign,
    bounded_rounds,
    initial_centers,
    kmeans_users,
    plain_rounds,
)
from shoptrail.operators.features import user_features
from shoptrail.plans.tables import events_log
from shoptrail.schemas import USER_FEATURES


def _features(spark, points):
    rows = [(u, *map(float, p)) for u, p in points.items()]
    return spark.createDataFrame(rows, USER_FEATURES)


def _run(features, **options):
    labels, centers = kmeans_users(features, **options)
    return (
        {r.user_id: r.cluster for r in labels.collect()},
        {r.cluster: (r.c1, r.c2, r.c3) for r in centers.collect()},
    )


def test_golden(golden):
    labels, centers = _run(user_features(golden))
    assert sorted(labels.values()) == [0, 1, 2]
    assert sorted(centers.values()) == [(0.0, 0.0, 0.0), (0.5, 1.0, 1.0), (1.0, 1.0, 0.875)]
    with pytest.raises(ValueError, match="at least 4"):
        kmeans_users(user_features(golden), k=4)


def test_empty_cluster_keeps_its_centre(spark):
    labels, centers = _run(_features(spark, {"a": (1, 2, 3), "b": (1, 2, 3)}), k=2)
    assert labels == {"a": 0, "b": 0}
    assert centers == {0: (1.0, 2.0, 3.0), 1: (1.0, 2.0, 3.0)}


def test_values_that_are_not_finite_take_no_part(spark):
    points = {"a": (0, 0, 0), "b": (1, 1, 1), "c": (float("nan"), 0, 0), "d": (float("inf"), 0, 0)}
    labels, _ = _run(_features(spark, points), k=2)
    assert sorted(labels) == ["a", "b"]


def test_centres_are_means_after_convergence(spark):
    rng = random.Random(1)
    points = {
        str(n): tuple(c + rng.random() / 10 for c in base)
        for n, base in enumerate([(0, 0, 0), (1, 0, 1), (0, 1, 1)] * 20)
    }
    labels, centers = _run(_features(spark, points), max_iter=50)
    assert set(labels.values()) <= {0, 1, 2}
    for cluster, centre in centers.items():
        members = [points[u] for u, c in labels.items() if c == cluster]
        for axis in range(3):
            mean = sum(m[axis] for m in members) / len(members)
            assert centre[axis] == pytest.approx(mean)


def test_partitioning_does_not_matter(spark):
    features = user_features(events_log(spark, TESTDATA))
    runs = [_run(features.coalesce(1)), _run(features.repartition(8))]
    assert runs[0][0] == runs[1][0]
    draws = [initial_centers(f).collect() for f in (features.coalesce(1), features.repartition(8))]
    assert draws[0] == draws[1]


def test_many_centres_give_the_same_labels(spark, monkeypatch):
    rng = random.Random(2)
    features = _features(spark, {str(n): [rng.random() for _ in range(3)] for n in range(100)})
    # A repeated centre makes ties, which the lower number wins.
    centers = [tuple(rng.random() for _ in range(3)) for _ in range(30)]
    centers += centers[:5]
    monkeypatch.setattr(geometry, "UNROLLED", 100)
    unrolled = assign(features, centers).collect()
    monkeypatch.setattr(geometry, "UNROLLED", 1)
    assert assign(features, centers).collect() == unrolled


def test_the_plan_does_not_grow_with_the_centres(spark):
    features = _features(spark, {str(n): (n, n, n) for n in range(10)})
    sizes = set()
    for k in (50, 500):
        found = assign(features, [(float(i), 0.0, 0.0) for i in range(k)])
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        sizes.add(len(plan.split()))
        assert found.count() == 10
    assert len(sizes) == 1


def test_a_round_is_one_combined_aggregation(spark):
    features = user_features(events_log(spark, TESTDATA))
    cluster = geometry.nearest([F.col(c) for c in ("f1", "f2", "f3")], [(0, 0, 0), (1, 1, 1)])
    plan = (
        features.groupBy(cluster.alias("c"))
        .agg(F.sum("f1"))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "partial_sum" in plan and "Python" not in plan


@pytest.mark.parametrize("max_iter", [0, 12])
def test_bounded_rounds_are_plain_rounds(spark, max_iter):
    rng = random.Random(5)
    places = [tuple(rng.random() for _ in range(3)) for _ in range(200)]
    # Sixteenths add up exactly; repeated points and centres make ties.
    points = [tuple(round(16 * (x + rng.random() / 20)) / 16 for x in p) for p in places * 10]
    points += points[:100]
    features = _features(spark, {str(n): p for n, p in enumerate(points)}).coalesce(1)
    centers = points[:195] + points[:5]
    labels, ends, all_users = plain_rounds(features, centers, max_iter, 0.0)
    bounded, bounded_ends, compared = bounded_rounds(features, centers, max_iter, 0.0)
    assert sorted(bounded.collect()) == sorted(labels.collect())
    assert bounded_ends == [pytest.approx(c, abs=1e-12) for c in ends]
    assert len(compared) == len(all_users)
    assert all(n == len(points) for n in all_users)
    assert compared[:1] == all_users[:1]


def test_bounds_spare_most_comparisons(spark):
    rng = random.Random(6)
    places = [tuple(rng.random() for _ in range(3)) for _ in range(200)]
    points = [tuple(x + rng.random() / 50 for x in p) for p in places * 15]
    features = _features(spark, {str(n): p for n, p in enumerate(points)}).coalesce(1)
    labels, _, all_users = plain_rounds(features, points[:200], 15, 0.0)
    bounded, _, compared = bounded_rounds(features, points[:200], 15, 0.0)
    assert sorted(bounded.collect()) == sorted(labels.collect())
    assert 2 * sum(compared[1:]) < sum(all_users[1:])
