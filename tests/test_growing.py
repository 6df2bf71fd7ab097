"""Index and graph that take new pairs, against those built at once."""

import random

import pytest
from pyspark.sql import functions as F

from shoptrail.operators.graph import build_graph
from shoptrail.operators.index import item_user_index
from shoptrail.operators.walk import graph_scores, rank_scores
from shoptrail.sources.growing_graph import add_links, read_graph, start_graph
from shoptrail.sources import growing_index
from shoptrail.sources.growing_index import _BLOCK, add_pairs, read_index, write_index


def _pairs(spark, rows):
    return spark.createDataFrame(sorted(set(rows)), "user_id string, item_id string")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _written(spark, path):
    """Items and sizes of the blocks of each generation."""
    table = spark.read.schema(_BLOCK).parquet(path)
    found = {}
    for r in table.select("generation", "item_id", F.size("users").alias("n")).collect():
        found.setdefault(r.generation, []).append((r.item_id, r.n))
    return {g: sorted(v) for g, v in found.items()}


@pytest.mark.parametrize("block_users", [1, 4, 7, 1000])
def test_merged_index_is_the_one_built_at_once(spark, tmp_path, block_users):
    rng = random.Random(block_users)
    ids = [str(n) for n in range(30)] + ["u1", "07", "", "é"]
    # One item with most users, one that comes late with many, and rare ones.
    rows = [(u, "hot") for u in ids] + [(u, str(rng.randrange(6))) for u in ids * 2]
    rng.shuffle(rows)
    parts = [rows[0::4], rows[1::4], rows[2::4], rows[3::4] + rows[::5]]
    parts.append([(u, "late") for u in ids] + [("0", "hot")])
    path = str(tmp_path / "index")
    write_index(_pairs(spark, parts[0]), path, block_users)
    for n, part in enumerate(parts[1:], 2):
        add_pairs(_pairs(spark, part), path, block_users)
        whole = _pairs(spark, sum(parts[:n], []))
        if n in (2, len(parts)):
            found = read_index(spark, path, block_users)
            assert _rows(found) == _rows(item_user_index(whole, block_users))
    assert max(n for blocks in _written(spark, path).values() for _, n in blocks) <= block_users
    # Read with another length of blocks.
    assert _rows(read_index(spark, path, 5)) == _rows(item_user_index(whole, 5))


def test_a_block_meets_only_the_bounds_inside_it(spark, tmp_path, monkeypatch):
    met = []

    def inside(bounds, name):
        found = growing_index_inside(bounds, name)
        met.append((name, bounds.count(), _rows(found.select(F.size("inside")))))
        return found

    growing_index_inside = growing_index._inside
    monkeypatch.setattr(growing_index, "_inside", inside)
    rows = [(str(u), "hot") for u in range(400)]
    path = str(tmp_path / "index")
    write_index(_pairs(spark, rows[::2]), path, 4)
    add_pairs(_pairs(spark, rows[1::2]), path, 4)
    assert [name for name, _, _ in met] == ["new", "old"]
    for _, bounds, sizes in met:
        # 50 blocks on either side, whose bounds fall between each other.
        assert bounds == 99
        assert sum(n for n, in sizes) == 49 and max(sizes) == (1,)
    whole = item_user_index(_pairs(spark, rows), 4)
    assert _rows(read_index(spark, path, 4)) == _rows(whole)


def test_only_blocks_with_new_users_are_written(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [(str(n), "large") for n in range(0, 200, 2)] + [("1", "other"), ("2", "third")]
    write_index(_pairs(spark, rows), path, 10)
    add_pairs(_pairs(spark, [("41", "large"), ("5", "other"), ("6", "new")]), path, 10)
    written = _written(spark, path)
    assert len(written[0]) == 12
    assert written[1] == [("large", 5), ("large", 6), ("new", 1), ("other", 2)]
    before = _rows(read_index(spark, path, 10))
    add_pairs(_pairs(spark, rows[:3]), path, 10)
    assert _rows(read_index(spark, path, 10)) == before


def test_empty_parts_of_an_index(spark, tmp_path):
    path, none = str(tmp_path / "index"), _pairs(spark, [("1", "a")]).limit(0)
    write_index(none, path)
    assert read_index(spark, path).isEmpty()
    add_pairs(none, path)
    add_pairs(_pairs(spark, [("1", "a")]), path)
    add_pairs(none, path)
    assert _rows(read_index(spark, path)) == [("a", 0, ["1"])]


def _links(graph):
    ends = graph.links.join(graph.users.select("user_id", "user"), "user").join(
        graph.items.select("item_id", "item"), "item"
    )
    return _rows(ends.select("user_id", "item_id", "user_degree", "item_degree"))


def test_a_grown_graph_is_the_whole_graph(spark, tmp_path):
    rng = random.Random(3)
    rows = [(str(rng.randrange(12)), str(rng.randrange(9))) for _ in range(60)] + [("t", "0")]
    path = str(tmp_path / "graph")
    start_graph(_pairs(spark, rows[40:]), path)
    first = read_graph(spark, path)
    numbers = {r.user_id: r.user for r in first.users.collect()}
    # Old and new nodes on either side, and links that are there already.
    add_links(_pairs(spark, rows[:50]), path)
    grown = read_graph(spark, path)
    after = {r.user_id: r.user for r in grown.users.collect()}
    assert {u: after[u] for u in numbers} == numbers
    assert sorted(after.values()) == list(range(len(after)))
    whole = _pairs(spark, rows)
    assert _links(grown) == _links(build_graph(whole))

    def scores(df):
        return {(r.kind, r.id): pytest.approx(r.score, abs=1e-9) for r in df.collect()}

    assert scores(graph_scores(grown, "t")) == scores(rank_scores(whole, "t"))


def test_a_part_that_broke_off_is_added_again(spark, tmp_path):
    path = str(tmp_path / "graph")
    start_graph(_pairs(spark, [("1", "a")]), path)
    # The numbers of new nodes were written, the links were not.
    spark.createDataFrame([("2", 1)], "user_id string, user long").write.parquet(
        f"{path}/user/part=7"
    )
    add_links(_pairs(spark, [("2", "a"), ("2", "b")]), path)
    add_links(_pairs(spark, [("1", "a")]).limit(0), path)
    found = read_graph(spark, path)
    assert _links(found) == [("1", "a", 1, 2), ("2", "a", 2, 2), ("2", "b", 2, 1)]
