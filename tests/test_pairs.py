import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from brute_force import id_key, items_of, top_pairs

from shoptrail.functions.text import id_order, is_plain_number
from shoptrail.operators import co_occurrence
from shoptrail.operators import pairs as pairs_module
from shoptrail.operators.co_occurrence import item_co_occurrence
from shoptrail.operators.index import item_user_index
from shoptrail.operators.pairs import attach, deep_pairs, degrees, without
from shoptrail.operators.positions import with_position
from shoptrail.plans.tables import crowded_pairs


def skewed_pairs(seed, users=60, items=80, hot_items=80):
    """A few hundred pairs; one user and one item hold about a third each."""
    rng = random.Random(seed)
    pairs = {("hot", str(i)) for i in range(hot_items)}
    pairs |= {(str(u), "0") for u in range(users)}
    for u in range(users):
        for _ in range(rng.randint(0, 6)):
            pairs.add((str(u), str(int(rng.paretovariate(0.8)) % items)))
    return pairs


def test_deep_pairs_and_index_golden(golden):
    pairs = deep_pairs(golden)
    assert sorted(map(tuple, pairs.collect())) == [
        ("1", "10"),
        ("1", "9"),
        ("2", "10"),
        ("2", "11"),
        ("2", "9"),
    ]
    index = {(r.item_id, r.block): r.users for r in item_user_index(pairs).collect()}
    assert index == {("9", 0): ["1", "2"], ("10", 0): ["1", "2"], ("11", 0): ["2"]}


def test_plain_numbers(spark):
    ids = {"0": True, "12": True, "-3": True, "07": False, "+1": False, "1a": False, "": False}
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    plain = df.select("id", is_plain_number(F.col("id")).alias("plain")).collect()
    assert {r.id: r.plain for r in plain} == ids


def test_id_order_is_total(spark):
    ids = ["9", "10", "1a", "07", "7", "", "-3", "b", "99999999999999999999"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    ordered = [r.id for r in df.orderBy(id_order(F.col("id"))).collect()]
    assert ordered == ["-3", "07", "7", "9", "10", "", "1a", "99999999999999999999", "b"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_positions(spark, partitions):
    ids = [str(i) for i in range(500)] + ["a", "b7"]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(partitions)
    found = {r.id: r.position for r in with_position(df, "id").collect()}
    assert found == {i: n for n, i in enumerate(sorted(ids, key=id_key))}


@pytest.mark.parametrize(("share", "limit"), [(0, 0), (1, 50), (4, 50), (100, 50), (4, 1000)])
@pytest.mark.parametrize("hashed", [0, 500_000])
def test_attach_is_an_inner_join(pairs_of, monkeypatch, share, limit, hashed):
    monkeypatch.setattr(pairs_module, "HOT_PER_PARTITION", share)
    monkeypatch.setattr(pairs_module, "BROADCAST_KEYS", limit)
    monkeypatch.setattr(pairs_module, "HASH_KEYS", hashed)
    pairs = skewed_pairs(1)
    df = pairs_of(pairs)
    keyed = degrees(df, "item_id").where("item_id <> '3'")
    degree = defaultdict(int)
    for _, i in pairs:
        degree[i] += 1
    joined = attach(df, keyed, "item_id", len(pairs)).select("user_id", "item_id", "degree")
    expected = sorted((u, i, degree[i]) for u, i in pairs if i != "3")
    assert sorted(map(tuple, joined.collect())) == expected
    rest = without(df, keyed, "item_id", len(pairs)).select("user_id", "item_id")
    assert sorted(map(tuple, rest.collect())) == sorted(p for p in pairs if p[1] == "3")


@pytest.mark.parametrize("block_users", [1, 7, 20, 1000])
@pytest.mark.parametrize(("broadcast_keys", "hot"), [(0, "hot"), (1000, "-12"), (1000, "007")])
def test_index_blocks_join_to_the_whole_list(
    pairs_of, monkeypatch, block_users, broadcast_keys, hot
):
    monkeypatch.setattr(pairs_module, "BROADCAST_KEYS", broadcast_keys)
    pairs = {(hot if u == "hot" else u, i) for u, i in skewed_pairs(2)}
    rows = item_user_index(pairs_of(pairs), block_users).orderBy("item_id", "block").collect()
    lists = defaultdict(list)
    for r in rows:
        assert len(r.users) <= block_users
        lists[r.item_id] += r.users
    expected = items_of((i, u) for u, i in pairs)
    assert dict(lists) == {i: sorted(us, key=id_key) for i, us in expected.items()}


def test_index_cuts_do_not_depend_on_partitioning(pairs_of):
    pairs = skewed_pairs(3)
    cuts = [
        sorted(map(tuple, item_user_index(pairs_of(pairs, n), 9).collect())) for n in (1, 8)
    ]
    assert cuts[0] == cuts[1]


def test_co_occurrence_golden(golden):
    rows = [tuple(r) for r in item_co_occurrence(deep_pairs(golden)).collect()]
    assert rows == [("9", "10", 2), ("9", "11", 1), ("10", "11", 1)]


def test_co_occurrence_of_single_items_is_empty(pairs_of):
    assert item_co_occurrence(pairs_of({("1", "a"), ("2", "a")})).isEmpty()
    assert item_co_occurrence(pairs_of(set())).isEmpty()


# One hot user set aside, all users set aside, lists cut, and none of these.
@pytest.mark.parametrize(
    ("list_items", "hot_users"), [(1000, 1024), (20, 1024), (3, 1024), (3, 2), (4, 0)]
)
@pytest.mark.parametrize(("top", "broadcast_keys"), [(1, 0), (5, 0), (40, 1000), (100_000, 0)])
def test_co_occurrence_limits_never_change_the_result(
    pairs_of, monkeypatch, list_items, hot_users, top, broadcast_keys
):
    monkeypatch.setattr(pairs_module, "BROADCAST_KEYS", broadcast_keys)
    # Some items hot, some not.
    monkeypatch.setattr(pairs_module, "HOT_PER_PARTITION", 3)
    pairs = skewed_pairs(4)
    found = item_co_occurrence(pairs_of(pairs), top, list_items, hot_users).collect()
    assert [tuple(r) for r in found] == top_pairs(pairs, top)


def test_co_occurrence_counts_many_hot_users(pairs_of):
    """More than one bitmap word, and pairs the hot users lift into the top."""
    rng = random.Random(5)
    pairs = {(f"h{u}", str(i)) for u in range(90) for i in rng.sample(range(40), 25)}
    pairs |= {(f"s{u}", str(i)) for u in range(200) for i in (0, 1, 2, rng.randrange(40))}
    found = item_co_occurrence(pairs_of(pairs), 3, 10, 1024).collect()
    assert [tuple(r) for r in found] == top_pairs(pairs, 3)


def test_text_ids_order_pairs(pairs_of):
    pairs = {("u", i) for i in ("9", "10", "1a")}
    rows = [tuple(r) for r in item_co_occurrence(pairs_of(pairs)).collect()]
    assert rows == [("9", "10", 1), ("9", "1a", 1), ("10", "1a", 1)]


def test_index_of_an_item_depends_on_its_own_users(pairs_of):
    pairs = {(str(u), "a") for u in range(111)} | {(str(u), "b") for u in range(30)}
    more = {(str(u), "c") for u in range(0, 4000, 3)}
    rows = [
        sorted(map(tuple, item_user_index(pairs_of(p), 50).where("item_id <> 'c'").collect()))
        for p in (pairs, pairs | more)
    ]
    assert rows[0] == rows[1]
    assert [(item, block, len(users)) for item, block, users in rows[0]] == [
        ("a", 0, 50), ("a", 1, 50), ("a", 2, 11), ("b", 0, 30),
    ]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("top", [1, 7, 60, 3000])
def test_largest_users_by_classes(pairs_of, seed, top):
    """A sparse log where a few users have very many items and the floor is low."""
    rng = random.Random(seed)
    pairs = {(f"h{h}", str(i)) for h in range(2 + seed) for i in rng.sample(range(90), 70)}
    pairs |= {(f"s{u}", str(rng.randrange(90))) for u in range(150)}
    pairs |= {(f"p{u}", str(i)) for u in range(20) for i in rng.sample(range(90), 2)}
    found = item_co_occurrence(pairs_of(pairs), top, list_items=10).collect()
    assert [tuple(r) for r in found] == top_pairs(pairs, top)


def test_one_user_with_all_items_costs_its_items(pairs_of, monkeypatch):
    """The rows that are listed follow ``top``, not the square of the user's items."""
    listed = []
    whole = co_occurrence._best_of_classes

    def counted(masks, top):
        best = whole(masks, top)
        listed.append(masks.count())
        return best

    monkeypatch.setattr(co_occurrence, "_best_of_classes", counted)
    monkeypatch.setattr(co_occurrence, "_count_cut_lists", None)
    for n in (500, 1000):
        pairs = {("all", str(i)) for i in range(n)} | {(f"u{i}", str(i)) for i in range(n)}
        found = [tuple(r) for r in item_co_occurrence(pairs_of(pairs), 20, 100).collect()]
        assert found == [("0", str(i), 1) for i in range(1, 21)]
    assert listed == [500, 1000]


@pytest.mark.parametrize("leading", [3, 1024])
@pytest.mark.parametrize(("seed", "top"), [(0, 1), (1, 9), (2, 150), (3, 5000)])
def test_many_large_users_by_classes(pairs_of, monkeypatch, leading, seed, top):
    """Seventy large users, two bitmap words, in a log whose floor is low."""
    monkeypatch.setattr(co_occurrence, "LEADING_CLASSES", leading)
    monkeypatch.setattr(co_occurrence, "CLASS_BLOCK", 7)
    monkeypatch.setattr(co_occurrence, "_count_cut_lists", None)
    rng = random.Random(seed)
    pairs = {(f"h{h}", str(i)) for h in range(70) for i in rng.sample(range(300), 12)}
    pairs |= {(f"h{h}", str(i)) for h in range(5) for i in range(0, 300, 2)}
    pairs |= {(f"s{u}", str(rng.randrange(300))) for u in range(150)}
    pairs |= {(f"p{u}", str(i)) for u in range(20) for i in rng.sample(range(300), 2)}
    found = item_co_occurrence(pairs_of(pairs), top, list_items=10).collect()
    assert [tuple(r) for r in found] == top_pairs(pairs, top)


def test_no_task_ranks_a_whole_class(spark):
    """One class of all items: windows are over ranges of it, and few rows are kept."""
    masks = spark.range(5000).select(F.col("id").alias("item"), F.lit(1).cast("long").alias("w0"))
    classes = co_occurrence._classes(masks, ["w0"])
    pairs = co_occurrence._best_class_pairs(classes, ["w0"], 20)
    assert [tuple(r) for r in pairs.collect()] == [(0, 0, 1, 5000)]
    ranked = co_occurrence._first_items(masks, classes, pairs, ["w0"], 20)
    assert sorted(map(tuple, ranked.collect())) == [(0, i, i + 1) for i in range(21)]
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    ranks = [line for line in plan.splitlines() if "row_number" in line and "Window" in line]
    assert ranks and all("range" in line.split("row_number")[1] for line in ranks)
    best = co_occurrence._best_of_classes(masks, 20).collect()
    assert [tuple(r) for r in best] == [(0, i, 0) for i in range(1, 21)]


def test_hot_starts_by_work(spark, pairs_of):
    """An item that starts many pairs is hot even if few users have it."""
    lists = [(f"u{u}", [0, *range(100, 110)]) for u in range(40)]
    lists += [(f"v{u}", [1]) for u in range(4000)]
    df = spark.createDataFrame(lists, "user_id string, items array<long>")
    hot = {r["a"] for r in co_occurrence._hot_starts(df).collect()}
    assert 0 in hot and 1 not in hot


def _ids(pairs_of, rng, users, items, most):
    rows = {(str(u), str(rng.randrange(items))) for u in range(users) for _ in range(rng.randint(0, most))}
    return rows, pairs_of(rows)


@pytest.mark.parametrize("task_pairs", [7, 1000])
def test_tasks_follow_the_pairs_counted(spark, pairs_of, monkeypatch, task_pairs):
    monkeypatch.setattr(co_occurrence, "TASK_PAIRS", task_pairs)
    rows, df = _ids(pairs_of, random.Random(task_pairs), 40, 60, 12)
    numbers = df.select("user_id", F.col("item_id").cast("bigint").alias("item"))
    expected = defaultdict(int)
    for items in items_of(rows).values():
        held = sorted(map(int, items))
        for n, a in enumerate(held):
            for b in held[n + 1 :]:
                expected[a, b] += 1
    total = sum(expected.values())
    for least in (0, 2):
        counts = co_occurrence._count_tails([co_occurrence._short(numbers)], least)
        found = {(r.a, r.b): r.cnt for r in counts.collect()}
        assert found == {p: n for p, n in expected.items() if n >= least}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert f"], {max(4, -(-total // task_pairs))}" in plan


@pytest.mark.parametrize("least", [1, 2])
def test_tails_of_cut_lists_are_counted_with_short_ones(spark, pairs_of, least):
    rows, df = _ids(pairs_of, random.Random(3), 30, 50, 40)
    numbers = df.select("user_id", F.col("item_id").cast("bigint").alias("item"))
    sized = numbers.join(degrees(numbers, "user_id"), "user_id")
    few, many = sized.where("degree <= 5"), sized.where("degree > 5")
    short = co_occurrence._short(few.select("user_id", "item"))
    counts = co_occurrence._count_cut_lists(short, many, 5, least)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    # Tails move, not the pairs: one counting after one shuffle.
    assert plan.count("RepartitionByExpression") == 1
    expected = defaultdict(int)
    for items in items_of(rows).values():
        held = sorted(map(int, items))
        for n, a in enumerate(held):
            for b in held[n + 1 :]:
                expected[a, b] += 1
    found = {(r.a, r.b): r.cnt for r in counts.collect()}
    assert found == {p: n for p, n in expected.items() if n >= least}


def test_parts_of_crowded_pairs_are_distinct_before_they_get_users(spark, tmp_path):
    keys = [(n,) for n in (0, 1, 2, 7, 22, 22, None, None)]
    spark.createDataFrame(keys, "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    df = crowded_pairs(spark, str(tmp_path))
    rows = [tuple(r) for r in df.collect()]
    expected = {("all", None if k is None else str(k)) for k, in keys} | {("c1", "1")}
    for u in range(24):
        for k, in keys:
            if u < 12 or (k is not None and k % (u - 10) != 0):
                expected.add((f"large{u}", None if k is None else str(k)))
    assert len(rows) == len(set(rows)) and set(rows) == expected
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(n for n, line in enumerate(lines) if "Generate" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    above = [line for line in lines[:at] if len(line) - len(line.lstrip(" :+-")) < depth]
    assert not any(line.lstrip(" :+-").startswith("Aggregate") for line in above[-3:])
