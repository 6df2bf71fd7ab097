import pytest
from given import TESTDATA
from pyspark.sql import functions as F

from shoptrail.operators.features import (
    feature_extrema,
    global_max_ts,
    raw_features,
    user_features,
    user_stats,
)
from shoptrail.plans.tables import _epoch_seconds, events_log
from shoptrail.schemas import BEHAVIOR_LOG


def _by_user(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_golden(golden):
    assert global_max_ts(golden).first()[0] == 345600
    assert _by_user(user_stats(golden)) == {
        "1": (172800, 3, 8),
        "2": (259200, 3, 9),
        "3": (345600, 1, 1),
    }
    assert _by_user(raw_features(golden)) == {
        "1": (2.0, 3.0, 8.0),
        "2": (1.0, 3.0, 9.0),
        "3": (0.0, 1.0, 1.0),
    }
    assert tuple(feature_extrema(golden).first()) == (0.0, 2.0, 1.0, 3.0, 1.0, 9.0)
    assert _by_user(user_features(golden)) == {
        "1": (1.0, 1.0, 0.875),
        "2": (0.5, 1.0, 1.0),
        "3": (0.0, 0.0, 0.0),
    }


def test_empty_log_has_no_features(spark):
    assert user_features(spark.createDataFrame([], BEHAVIOR_LOG)).isEmpty()


def test_one_user_is_all_zero(spark):
    log = spark.createDataFrame([("1", "2", "3", "buy", 7), ("1", "2", "3", "pv", 9)], BEHAVIOR_LOG)
    assert _by_user(user_features(log)) == {"1": (0.0, 0.0, 0.0)}


def test_each_feature_spans_zero_to_one(spark):
    rows = user_features(events_log(spark, TESTDATA)).collect()
    for c in ("f1", "f2", "f3"):
        assert min(r[c] for r in rows) == 0.0
        assert max(r[c] for r in rows) == 1.0


@pytest.mark.parametrize("places", [4, None])
def test_partitioning_does_not_matter(spark, places):
    log = events_log(spark, TESTDATA)
    one = _by_user(user_features(log.coalesce(1), places))
    assert one == _by_user(user_features(log.repartition(8), places))


def test_log_is_scanned_once(spark):
    df = user_features(events_log(spark, TESTDATA))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    assert "PushedFilters: [In(event_type" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_log_times_do_not_depend_on_the_session_zone(spark, zone):
    times = {
        "2024-07-01 12:00:00.7": 1719835200,
        "2024-03-10 02:30:00": 1710037800,  # a local time New York skips
        "1969-12-31 23:59:58.5": -2,
    }
    df = spark.createDataFrame([(t,) for t in times], "t string")
    df = df.select("t", F.col("t").cast("timestamp_ntz").alias("ts"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = {r.t: r.s for r in df.select("t", _epoch_seconds("ts").alias("s")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == times
