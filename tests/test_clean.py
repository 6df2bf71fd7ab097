import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation

from shoptrail.constants import ALL_BEHAVIORS, DEEP_BEHAVIORS
from shoptrail.operators.clean import clean_behavior_log, line_verdicts
from shoptrail.plans.jobs import read_log
from shoptrail.sources.text_files import parse_feature_lines
from shoptrail.streaming.clean_stream import clean_arrivals

KEPT = ("1", "10", "100", "buy")
LINES = {
    "1,10,100,buy,86400": (*KEPT, 86400),
    " 1 , 10 ,100, buy ,\t86400 ": (*KEPT, 86400),
    "1,10,100,buy,5,extra": (*KEPT, 5),
    "1,10,100,buy,5,": (*KEPT, 5),
    "1,10,100,buy,+5": (*KEPT, 5),
    "1,10,100,buy,-5": (*KEPT, -5),
    '"1",10,100,buy,5': ('"1"', "10", "100", "buy", 5),
    "": "empty line",
    "  \t ": "empty line",
    "user_id,item_id,category_id,behavior_type,timestamp": "header",
    "USER_ID,x": "header",
    "user_id7,10,100,pv,1": "header",
    "1,10,100,buy": "too few fields",
    "1,,100,buy,5": "blank field",
    "1, ,100,buy,5": "blank field",
    "1,10,100,buy,": "blank field",
    "1,10,100,BUY,5": "unknown behavior",
    "1,10,100,click,5": "unknown behavior",
    "1,10,100,buy,abc": "bad timestamp",
    "1,10,100,buy,5.7": "bad timestamp",
    "1,10,100,buy,1e3": "bad timestamp",
    "1,10,100,buy,99999999999999999999": "bad timestamp",
}


def _lines(spark):
    return spark.createDataFrame([(line,) for line in LINES], "value string")


def _records():
    return sorted(v for v in LINES.values() if isinstance(v, tuple))


def test_each_line(spark):
    for line, expected in LINES.items():
        one = spark.createDataFrame([(line,)], "value string").coalesce(1)
        rows = [tuple(r) for r in clean_behavior_log(one).collect()]
        assert rows == ([expected] if isinstance(expected, tuple) else []), line


def test_verdicts(spark):
    found = {r.verdict: r.line_count for r in line_verdicts(_lines(spark)).collect()}
    expected: dict[str, int] = {}
    for v in LINES.values():
        name = "kept" if isinstance(v, tuple) else v
        expected[name] = expected.get(name, 0) + 1
    assert found == expected


def test_null_line_is_dropped(spark):
    assert clean_behavior_log(spark.createDataFrame([(None,)], "value string")).isEmpty()


def test_fold_case_and_valid_set(spark):
    lines = spark.createDataFrame([("1,10,100,Buy,5",), ("1,10,100,pv,6",)], "value string")
    assert [tuple(r) for r in clean_behavior_log(lines, fold_case=True).collect()] == [
        (*KEPT, 5),
        ("1", "10", "100", "pv", 6),
    ]
    assert clean_behavior_log(lines, DEEP_BEHAVIORS).isEmpty()


def test_observed_counts(spark):
    seen = Observation()
    clean_behavior_log(_lines(spark), observation=seen).collect()
    assert seen.get == {"lines": len(LINES), "kept": len(_records())}


def test_stream_gives_the_batch_result_once(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    _lines(spark).coalesce(1).write.text(source)
    clean_arrivals(spark, source, out, progress).awaitTermination()
    clean_arrivals(spark, source, out, progress).awaitTermination()
    found = read_log(spark, out, "parquet").collect()
    assert sorted(tuple(r) for r in found) == _records()


def test_feature_lines(spark):
    lines = {
        "1,0.5,0.25,1.0": ("1", 0.5, 0.25, 1.0),
        " 2 , 0.5 ,\t1e-1,.5,more": ("2", 0.5, 0.1, 0.5),
        "user_id,f1,f2,f3": None,
        "": None,
        "1,0.5,0.25": None,
        "1,0.5,abc,1": None,
        " ,0.5,0.25,1": None,
        "1,NaN,0.25,1": None,
        "1,Infinity,0.25,1": None,
    }
    df = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    assert [tuple(r) for r in parse_feature_lines(df).collect()] == [
        v for v in lines.values() if v
    ]


BLANKS = "".join(map(chr, range(0x21)))
FIELD = st.one_of(
    st.sampled_from(["1", "10", "user_id", "pv", "buy", "cart", "fav", "BUY", "click", ""]),
    st.integers(-(2**70), 2**70).map(str),
    st.text("+-0159. \ta\u00a0\u00fc", max_size=4),
)
LINE = st.builds(
    lambda fields, left, right: left + ",".join(fields) + right,
    st.one_of(
        st.lists(FIELD, max_size=7),
        st.tuples(FIELD, FIELD, FIELD, st.sampled_from(ALL_BEHAVIORS), FIELD).map(list),
    ),
    st.sampled_from(["", " ", "\t ", "\x01"]),
    st.sampled_from(["", " ", "\t"]),
)


def _by_rule(line):
    line = line.strip(BLANKS)
    fields = [f.strip(BLANKS) for f in line.split(",")]
    if line.lower().startswith("user_id") or len(fields) < 5 or "" in fields[:5]:
        return None
    if fields[3] not in ALL_BEHAVIORS or not re.fullmatch(r"[+-]?[0-9]+", fields[4]):
        return None
    ts = int(fields[4])
    return (*fields[:4], ts) if -(2**63) <= ts < 2**63 else None


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(lines=st.lists(LINE, min_size=20, max_size=200))
def test_any_lines(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    expected = [r for r in map(_by_rule, lines) if r]
    assert [tuple(r) for r in clean_behavior_log(df).collect()] == expected


def test_lines_are_split_once_per_row(spark):
    plan = clean_behavior_log(_lines(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1
    assert "Python" not in plan
