from collections import Counter

import pytest

from shoptrail.llm.sharding import SHARDS, SLOTS, place, shard_table, write_shards


def plain_table(names, slots):
    """Turns over the whole preference orders."""
    import xxhash

    orders = []
    for n in names:
        at = xxhash.xxh64_intdigest(n.encode(), 1) % slots
        step = xxhash.xxh64_intdigest(n.encode(), 2) % (slots - 1) + 1
        orders.append([(at + k * step) % slots for k in range(slots)])
    table, turn = {}, 0
    while len(table) < slots:
        free = next(s for s in orders[turn % len(names)] if s not in table)
        table[free] = turn % len(names)
        turn += 1
    return [table[s] for s in range(slots)]


def test_table_equals_whole_orders():
    names = [f"n{i}" for i in range(7)]
    assert shard_table(names, 251) == plain_table(names, 251)


def test_shards_have_equal_numbers_of_slots():
    sizes = Counter(shard_table(SHARDS)).values()
    assert sum(sizes) == SLOTS and max(sizes) - min(sizes) <= 1


def test_few_slots_move_when_a_shard_goes():
    before = shard_table(SHARDS, 6553 + 10)
    after = shard_table(SHARDS[:-1], 6553 + 10)
    moved = sum(a != b for a, b in zip(before, after, strict=True))
    assert moved < 3 * len(before) / len(SHARDS)


@pytest.mark.parametrize("shards, slots", [([], 7), (["a", "a"], 7), (["a", "b"], 8), (["a"] , 1)])
def test_bad_tables_are_errors(shards, slots):
    with pytest.raises(ValueError):
        shard_table(shards, slots)


def test_places_follow_the_table(spark, tmp_path):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    placed = place(docs)
    table = shard_table(SHARDS)
    rows = placed.collect()
    assert all(r["shard"] == SHARDS[table[r["slot"]]] for r in rows)
    assert max(Counter(r["shard"] for r in rows).values()) < 1.3 * 20_000 / 64
    write_shards(placed.limit(500), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 500
