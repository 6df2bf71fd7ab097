import pytest
from brute_force import id_key
from brute_force import walk as walk_by_definition
from pyspark.sql import functions as F
from test_pairs import skewed_pairs

from shoptrail.functions.numbers import twelve_digits
from shoptrail.operators import walk as walk_module
from shoptrail.operators.graph import build_graph, graph_edges, graph_nodes
from shoptrail.operators.pairs import deep_pairs
from shoptrail.operators.walk import best_items, personal_rank, rank_scores, walk_from

SHUFFLED = {"broadcast_rows": 0, "split_links": 3}


def _scores(df):
    return {(r.kind, r.id): r.score for r in df.collect()}


@pytest.mark.parametrize(
    ("rounds", "expected"),
    [
        (1, {("user", "1"): 0.15, ("item", "9"): 0.425, ("item", "10"): 0.425}),
        (
            2,
            {
                ("user", "1"): 0.51125,
                ("user", "2"): 0.36125,
                ("item", "9"): 0.06375,
                ("item", "10"): 0.06375,
            },
        ),
        (
            20,
            {
                ("user", "1"): 0.325661,
                ("user", "2"): 0.232688,
                ("item", "9"): 0.191156,
                ("item", "10"): 0.191156,
                ("item", "11"): 0.059339,
            },
        ),
    ],
)
def test_golden_rounds(golden, rounds, expected):
    found = _scores(rank_scores(deep_pairs(golden), "1", max_iter=rounds))
    assert found == pytest.approx(expected, abs=1e-6)


def test_large_vectors_are_sorted_not_hashed(pairs_of, monkeypatch):
    monkeypatch.setattr(walk_module, "HASH_ROWS", 0)
    pairs = skewed_pairs(10)
    expected, _ = walk_by_definition(pairs, "hot", max_iter=3)
    found = _scores(rank_scores(pairs_of(pairs), "hot", max_iter=3, **SHUFFLED))
    assert found == pytest.approx(expected, abs=1e-12)


def test_golden_recommendation(golden):
    pairs = deep_pairs(golden)
    (row,) = personal_rank(pairs, "1").collect()
    assert (row.rank, row.item_id, round(row.score, 3)) == (1, "11", 0.059)
    assert personal_rank(pairs, "unknown").isEmpty()
    assert personal_rank(pairs, "3").isEmpty()


def test_unknown_target_keeps_its_restart(golden):
    assert _scores(rank_scores(deep_pairs(golden), "3")) == pytest.approx({("user", "3"): 0.15})


def test_include_unreached_adds_zeros(golden):
    dense = _scores(rank_scores(deep_pairs(golden), "1", include_unreached=True, max_iter=1))
    assert dense[("item", "11")] == 0.0 and dense[("user", "2")] == 0.0
    for rounds in (0, 1):
        (row,) = personal_rank(
            deep_pairs(golden), "1", include_unreached=True, max_iter=rounds
        ).collect()
        assert (row.item_id, row.score) == ("11", 0.0)
    rows = personal_rank(deep_pairs(golden), "unknown", include_unreached=True).collect()
    assert [(r.item_id, r.score) for r in rows] == [("9", 0.0), ("10", 0.0), ("11", 0.0)]


@pytest.mark.parametrize("options", [{}, SHUFFLED, {"broadcast_rows": 0}])
@pytest.mark.parametrize(
    "limits", [{}, {"max_iter": 0}, {"max_iter": 200}, {"alpha": 0.5, "tol": 1e-2}, {"alpha": 1.0}]
)
def test_same_as_the_definition(pairs_of, options, limits):
    pairs = skewed_pairs(6)
    expected, rounds = walk_by_definition(pairs, "7", **limits)
    graph = build_graph(pairs_of(pairs))
    assert walk_from(graph, "7", **limits, **options).rounds == rounds
    found = _scores(rank_scores(pairs_of(pairs), "7", **limits, **options))
    positive = {n: r for n, r in expected.items() if r > 0}
    assert {n: r for n, r in found.items() if r > 0} == pytest.approx(positive, abs=1e-12)


def test_ranks_sum_to_one(pairs_of):
    df = pairs_of(skewed_pairs(7))
    for rounds in (1, 2, 7):
        total = sum(_scores(rank_scores(df, "hot", max_iter=rounds)).values())
        assert total == pytest.approx(1.0, abs=1e-12)


def test_partitioning_does_not_matter(pairs_of):
    pairs = skewed_pairs(8)
    one, many = (
        [(r.item_id, round(r.score, 9)) for r in personal_rank(pairs_of(pairs, n), "5").collect()]
        for n in (1, 8)
    )
    assert one == many


@pytest.mark.parametrize("split_links", [3, 1000])
def test_links_stay_put_between_rounds(pairs_of, spark, split_links):
    """Beyond the broadcast limit only the vector moves, not the links."""
    graph = build_graph(pairs_of(skewed_pairs(9)))
    side = walk_module._Side(graph, "user", 0, split_links)
    vector = graph.users.selectExpr("user AS node", "1.0D AS x")
    met = side.step(vector, rows=10)
    plan = met._jdf.queryExecution().executedPlan().toString()
    side.close()
    join = plan[plan.index("ShuffledHashJoin") :]
    assert join.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan
    assert "shoptrail_links" not in {t.name for t in spark.catalog.listTables()}


def test_twelve_digits(spark):
    values = [0.1 + 0.2, 0.3, 1e-15, 1.1e-15, 1e-15 + 1e-30, 0.0, 2.5e-9, 2.5e-9 + 1e-18]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    cut = [r.c for r in df.select(twelve_digits(F.col("v")).alias("c")).collect()]
    assert cut[0] == cut[1] and cut[2] == cut[4] and cut[2] < cut[3] and cut[5] == 0.0
    assert cut[6] < cut[7]
    assert cut == pytest.approx(values, rel=1e-11)


def test_one_graph_serves_many_targets(pairs_of):
    pairs = skewed_pairs(11)
    graph = build_graph(pairs_of(pairs))
    for target in ("hot", "3", "nobody"):
        found = [tuple(r) for r in best_items(graph, target).collect()]
        ranks, _ = walk_by_definition(pairs, target)
        own = {i for u, i in pairs if u == target}
        new = [(-round(r, 12), id_key(i), r) for (k, i), r in ranks.items() if k == "item"]
        expected = [n for n in sorted(new) if n[1][2] not in own][:10]
        assert [i for _, i, _ in found] == [n[1][2] for n in expected]
        assert [s for *_, s in found] == pytest.approx([n[2] for n in expected])
        assert [r for r, *_ in found] == list(range(1, len(expected) + 1))


def test_same_id_for_user_and_item(pairs_of):
    edges = graph_edges(pairs_of({("1", "1"), ("1", "2"), ("2", "1")})).collect()
    chances = {(e.src_kind, e.src, e.dst_kind, e.dst): e.p for e in edges}
    assert len(chances) == 6
    assert chances["user", "1", "item", "1"] == 0.5
    assert chances["user", "2", "item", "1"] == 1.0
    assert chances["item", "2", "user", "1"] == 1.0


def test_nodes_golden(golden):
    found = sorted(map(tuple, graph_nodes(deep_pairs(golden)).collect()))
    assert found == [
        ("item", "10", 2),
        ("item", "11", 1),
        ("item", "9", 2),
        ("user", "1", 2),
        ("user", "2", 3),
    ]
