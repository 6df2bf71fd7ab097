"""Sharding by a permutation-filled look-up table.

Each shard has its own order of the slots of a prime-sized table. The shards
take turns, each claiming the first slot of its order that is still free. Shards
so get the same number of slots, give or take one, and adding or removing a
shard moves few others. The table has a fixed size and is broadcast; placing a
document is one look-up.
"""

from __future__ import annotations

from collections.abc import Sequence

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
# The most slots, so that the broadcast table stays within some 100 MB.
MOST_SLOTS = 4_000_037


def shard_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the position in ``shards`` of the shard that claimed it.

    ``slots`` is a prime of at least the number of shards.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names")
    if not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"the table has {len(shards)} to {MOST_SLOTS} slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("a prime number of slots makes every order visit all of them")
    names = [s.encode() for s in shards]
    following = [xxhash.xxh64_intdigest(s, 1) % slots for s in names]
    step = [xxhash.xxh64_intdigest(s, 2) % (slots - 1) + 1 for s in names]
    table = [-1] * slots
    for claimed in range(slots):
        shard = claimed % len(shards)
        slot = following[shard]
        while table[slot] >= 0:
            slot = (slot + step[shard]) % slots
        table[slot] = shard
        following[shard] = (slot + step[shard]) % slots
    return table


def place(
    docs: DataFrame,
    shards: Sequence[str] = SHARDS,
    key: str = "doc_id",
    slots: int = SLOTS,
) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``, from a hash of ``key``.

    Columns of these names are replaced. Rows with equal keys, null among them,
    share a shard. No row moves.
    """
    table = docs.sparkSession.createDataFrame(
        [(slot, shards[shard]) for slot, shard in enumerate(shard_table(shards, slots))],
        "slot int, shard string",
    )
    others = [c for c in docs.columns if c not in ("slot", "shard")]
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int")
    slotted = docs.select(*others, slot.alias("slot"))
    return slotted.join(F.broadcast(table), "slot").select(*others, "slot", "shard")


def write_shards(placed: DataFrame, path: str) -> None:
    """A folder per shard. Every task writes its own file into each."""
    placed.write.partitionBy("shard").parquet(path)
