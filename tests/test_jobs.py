from pathlib import Path
from unittest.mock import Mock

import pytest
from given import GOLDEN
from pyspark.sql import Observation

from shoptrail.__main__ import main
from shoptrail.constants import DEEP_BEHAVIORS
from shoptrail.operators.counts import log_counts
from shoptrail.operators.pairs import deep_pairs, written_pairs
from shoptrail.plans import jobs
from shoptrail.schemas import BEHAVIOR_LOG
from shoptrail.sources import exports
from shoptrail.sources.durable import durable, run_folder, shared_folder
from shoptrail.sources.text_files import feature_verdicts, parse_feature_lines


@pytest.fixture(scope="module")
def raw_log(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "log.csv"
    lines = ["user_id,item_id,category_id,behavior_type,timestamp", "", "bad"]
    lines += [",".join(map(str, row)) for row in GOLDEN]
    path.write_text("\n".join(lines))
    return str(path)


def _read(folder):
    parts = sorted(Path(folder).glob("part-*.txt"))
    return [line for p in parts for line in p.read_text().splitlines()]


def test_the_four_jobs(spark, raw_log, tmp_path):
    out = str(tmp_path)
    assert jobs.clean_and_features(spark, raw_log, out) == {"lines": 10, "kept": 7}
    lines = _read(f"{out}/clean_behavior_log.csv")
    assert sorted(lines) == sorted(",".join(map(str, r)) for r in GOLDEN)
    assert sorted(_read(f"{out}/user_features.csv")) == [
        "1,1.0000,1.0000,0.8750",
        "2,0.5000,1.0000,1.0000",
        "3,0.0000,0.0000,0.0000",
    ]

    for form, ending in (("text", "csv"), ("parquet", "parquet")):
        log = f"clean_behavior_log.{ending}"
        jobs.index_and_co_occurrence(spark, f"{out}/{log}", out, form)
        assert _read(f"{out}/item_user_inverted_index.txt") == ["10\t0\t1,2", "11\t0\t2", "9\t0\t1,2"]
        assert _read(f"{out}/item_co_occurrence.txt") == ["9,10\t2", "9,11\t1", "10,11\t1"]
        jobs.recommend(spark, f"{out}/{log}", "1", out, form=form)
        assert _read(f"{out}/personal_rank_recommendations.txt") == ["1\t11:0.059"]
    jobs.recommend(spark, raw_log, "nobody", out)
    assert _read(f"{out}/personal_rank_recommendations.txt") == ["nobody\t"]

    for form, features in (("text", "user_features.csv"), ("parquet", "user_features.parquet")):
        jobs.cluster_users(spark, f"{out}/{features}", out, form=form)
        labels = _read(f"{out}/user_cluster_labels.csv")
        assert [line.split(",")[0] for line in labels] == ["1", "2", "3"]
        centers = _read(f"{out}/cluster_centers.txt")
        assert [c.split("\t")[0] for c in centers] == ["0", "1", "2"]
        assert sorted(c.split("\t")[1] for c in centers) == [
            "0.0000,0.0000,0.0000",
            "0.5000,1.0000,1.0000",
            "1.0000,1.0000,0.8750",
        ]


def test_command_line(spark, raw_log, tmp_path, capsys):
    out = str(tmp_path)
    main(["features", raw_log, out])
    assert "7 of 10 lines" in capsys.readouterr().out
    main(["pairs", f"{out}/clean_behavior_log.parquet", out, "--form", "parquet", "--top", "1"])
    assert _read(f"{out}/item_co_occurrence.txt") == ["9,10\t2"]
    main(["clusters", f"{out}/user_features.csv", out, "--k", "2"])
    assert len(_read(f"{out}/cluster_centers.txt")) == 2
    main(["recommend", f"{out}/clean_behavior_log.csv", "1", out, "--alpha", "0.5"])
    assert _read(f"{out}/personal_rank_recommendations.txt")[0].startswith("1\t11:")


def test_a_cluster_needs_a_shared_folder():
    session = Mock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = "yarn"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)
    session.conf.get.return_value = "/shared/"
    assert shared_folder(session) == "/shared"


def test_views_are_not_read_for_deep_pairs(spark, golden, tmp_path):
    path = str(tmp_path / "log.parquet")
    exports.write_table(golden, path, "behavior")
    log = jobs.read_log(spark, path, "parquet")
    assert log.schema == BEHAVIOR_LOG
    assert sorted(map(tuple, log.collect())) == sorted(GOLDEN)
    deep = deep_pairs(jobs.read_log(spark, path, "parquet", DEEP_BEHAVIORS))
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [behavior" in plan
    assert "ReadSchema: struct<user_id:string,item_id:string>" in plan


def test_counts(golden):
    counts = {r.metric: r.row_count for r in log_counts(golden, deep_pairs(golden)).collect()}
    assert counts == {"records": 7, "users": 3, "pairs": 5, "edges": 10, "nodes": 5}
    none = golden.where("false")
    counts = {r.metric: r.row_count for r in log_counts(none, deep_pairs(none)).collect()}
    assert counts == {"records": 0, "users": 0, "pairs": 0, "edges": 0, "nodes": 0}


def test_a_run_deletes_its_own_folder_only(spark, golden):
    kept = durable(golden, "kept")
    with run_folder(spark):
        inside = durable(golden, "inside")
        folder = Path(inside.inputFiles()[0].removeprefix("file:")).parent
        assert folder.exists() and folder.parent.name.startswith("run-")
    assert not folder.parent.exists()
    assert kept.count() == len(GOLDEN)
    with pytest.raises(ZeroDivisionError), run_folder(spark):
        folder = Path(durable(golden, "in").inputFiles()[0].removeprefix("file:")).parent
        1 / 0
    assert not folder.exists()


def test_durable_writes_once_to_the_shared_folder(spark, golden):
    once = durable(golden, "golden")
    assert durable(once, "again") is once
    pairs = written_pairs(deep_pairs(golden))
    assert written_pairs(pairs) is pairs
    assert written_pairs(pairs.withColumn("more", pairs.user_id)).columns == pairs.columns
    assert all(shared_folder(spark) in f for f in once.inputFiles())
    assert sorted(map(tuple, once.collect())) == sorted(GOLDEN)


def _plans(spark):
    """Texts of the plans that ran so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [store.apply(i).physicalPlanDescription() for i in range(store.size())]


def test_partitioned_write_needs_no_sort(spark, raw_log, tmp_path):
    jobs.clean_and_features(spark, raw_log, str(tmp_path))
    writes = [p for p in _plans(spark) if f"{tmp_path}/clean_behavior_log.parquet" in p and "WriteFiles" in p]
    assert writes and not any("Sort" in p for p in writes)
    folders = sorted(p.name for p in (tmp_path / "clean_behavior_log.parquet").glob("behavior=*"))
    assert folders == [f"behavior={b}" for b in ("buy", "cart", "fav", "pv")]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_dropped_feature_lines_are_counted(spark):
    lines = ["user_id,f1,f2,f3", "1,0.1,0.2,0.3", "2,0.1,nan,0.3", "3,1", ",1,2,3", "", "4,1,2,x"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    counts = {r["verdict"]: r["line_count"] for r in feature_verdicts(df).collect()}
    assert counts == {
        "header": 1, "kept": 1, "not a finite number": 2, "too few fields": 1,
        "blank user": 1, "empty line": 1,
    }
    seen = Observation()
    assert parse_feature_lines(df, seen).count() == 1
    assert seen.get == {"lines": 7, "kept": 1}


def test_a_cluster_of_local_processes_needs_a_shared_folder(monkeypatch):
    session = Mock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        shared_folder(session)
