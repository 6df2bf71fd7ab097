"""Parts of a log, rejects beside records, and the order of written files."""

import pytest
from pyspark.sql import functions as F

from shoptrail.operators.clean import records_and_rejects
from shoptrail.operators.features import user_features, user_stats
from shoptrail.plans.jobs import add_log_part, clean_and_features, read_log, read_rejects
from shoptrail.schemas import USER_FEATURES
from shoptrail.sources import exports
from shoptrail.sources.stats_parts import read_stats, write_part
from shoptrail.sources.text_files import read_ordered_lines


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_parts_merge_in_any_order_and_count_once(spark, golden, tmp_path):
    path = str(tmp_path / "stats")
    whole = _rows(user_stats(golden))
    early, late = golden.where("user_id = '1'"), golden.where("user_id <> '1'")
    for log, part in ((late, "b"), (early, "a"), (late, "b"), (golden.limit(0), "none")):
        write_part(log, path, part)
    assert _rows(read_stats(spark, path).select("user_id", "last_ts", "event_count", "score")) == whole
    # A part that is replaced leaves nothing of what it was.
    write_part(late.where("behavior = 'buy'"), path, "b")
    left = early.unionByName(late.where("behavior = 'buy'"))
    found = read_stats(spark, path).select("user_id", "last_ts", "event_count", "score")
    assert _rows(found) == _rows(user_stats(left))


@pytest.mark.parametrize("part", ["", "a/b", "..", "a=b", "a b"])
def test_names_of_parts(golden, tmp_path, part):
    with pytest.raises(ValueError, match="no name"):
        write_part(golden, str(tmp_path), part)


def test_a_merge_reads_no_events(spark, golden, tmp_path):
    write_part(golden, str(tmp_path), "a")
    plan = read_stats(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "behavior" not in plan and plan.count("FileScan") == 1


def test_job_in_parts_gives_the_features_of_the_whole(spark, golden, tmp_path):
    for n in (0, 1):
        log = golden.where(F.pmod("ts", F.lit(2)) == n)
        exports.write_lines(exports.log_lines(log), f"{tmp_path}/log{n}")
        add_log_part(spark, f"{tmp_path}/log{n}", f"day{n}", str(tmp_path))
    found = spark.read.schema(USER_FEATURES).parquet(f"{tmp_path}/user_features.parquet")
    assert _rows(found) == _rows(user_features(golden))


def test_rejects_beside_records(spark, tmp_path):
    lines = ["1,2,3,buy,5", "", " x ", "1,2,3,rejected,5", "1,2,3,pv,x", "9,8,7,pv,6", "", "\t"]
    (tmp_path / "raw").write_text("\n".join(lines) + "\n")
    counts = clean_and_features(spark, f"{tmp_path}/raw", str(tmp_path / "out"), keep_rejects=True)
    assert counts == {"lines": 8, "kept": 2}
    table = f"{tmp_path}/out/clean_behavior_log.parquet"
    assert _rows(read_log(spark, table, "parquet")) == [
        ("1", "2", "3", "buy", 5), ("9", "8", "7", "pv", 6),
    ]
    assert _rows(read_rejects(spark, table)) == [
        ("", "empty line"), ("", "empty line"), ("", "empty line"),
        ("1,2,3,pv,x", "bad timestamp"), ("1,2,3,rejected,5", "unknown behavior"),
        ("x", "too few fields"),
    ]


def test_records_and_rejects_are_one_pass(spark, tmp_path):
    (tmp_path / "raw").write_text("1,2,3,buy,5\n")
    both = records_and_rejects(spark.read.text(f"{tmp_path}/raw"))
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    with pytest.raises(ValueError, match="rejected"):
        records_and_rejects(both.select(F.lit("").alias("value")), valid=["buy", "rejected"])


def test_rejected_null_lines(spark):
    row = records_and_rejects(spark.createDataFrame([(None,)], "value string")).first()
    assert (row.behavior, row.line, row.reason) == ("rejected", None, "empty line")


@pytest.mark.parametrize("block", ["200", "128m"])
def test_positions_follow_files_and_blocks(spark, tmp_path, block):
    written = [f"line {n:04d}" for n in range(300)]
    lines = spark.createDataFrame([(v,) for v in written], "value string")
    exports.write_lines(lines.repartition(5).orderBy("value"), str(tmp_path / "export"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        found = _rows(read_ordered_lines(spark, str(tmp_path / "export")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == list(enumerate(written))
    # Without a sort the positions tell.
    exports.write_lines(lines.orderBy(F.desc("value")), str(tmp_path / "other"))
    other = _rows(read_ordered_lines(spark, str(tmp_path / "other")))
    assert [v for _, v in other] == written[::-1]
