"""SimHash near-duplicates: fingerprints joined on Golay code words.

A fingerprint is cut into three segments of 22, 21 and 21 bits, each decoded by
the perfect (23, 12) Golay code. A segment's keys are the code words nearest to
it and to each of its one-bit neighbours: one key or six. Two segments that
differ in up to two bits have the bits halfway between them in both balls, so
they share a key.

Of up to four differing bits, a segment may hold three or more; then one of the
other two is equal and the other differs in one bit at most. Or every segment
holds at most two. So two fingerprints in reach share a key of one of two kinds:

* an equal segment with a Golay key of another (six ordered pairs), 33 bits;
* a Golay key of every segment, 36 bits.

Both kinds are selective enough for billions of fingerprints. Each pair of
fingerprints under a key is verified by its bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import LOWER, documents, id_or_last, keyed, per_text, text_key
from shoptrail.llm.components import connected
from shoptrail.session import settings
from shoptrail.operators.pairs import attach
from shoptrail.sources.durable import durable

SHINGLE = 4
MAX_BITS = 4
SEED = 42

# The generator polynomial of the Golay code, and its word length.
_GENERATOR, _LENGTH = 0xC75, 23
_SEGMENTS = ((0, 22), (22, 21), (43, 21))
# The most fingerprints under one key that are compared in one step.
BLOCK = 8192
_LIST = 8
_SHINGLES_AT_ONCE = 1 << 16
_SIGNED = 1 << 64

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_BYTE_OFFSETS = np.arange(8) * 256


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as a signed 64-bit number; 0 if it has no word."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros((8, 8), np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, _SHINGLES_AT_ONCE):
        high = min(n, low + _SHINGLES_AT_ONCE)
        start = ends[low - 1 : high - 1] if low else np.append(0, ends[: high - 1])
        stop = ends[low + shingle - 1 : high + shingle - 1] if n > 1 else ends[-1:]
        hashes = [
            digest(joined[i:j], SEED)
            for i, j in zip(start.tolist(), (stop - 1).tolist(), strict=False)
        ]
        parts = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8) + _BYTE_OFFSETS
        seen = np.bincount(parts.ravel(), minlength=2048).reshape(8, 256)
        ones += seen @ _BITS_OF_BYTE
    bits = np.packbits((2 * ones > n).ravel(), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_key, fingerprint)`` per row; ``text_key`` tells a row's texts apart."""
    keyed = documents(docs, text_key().alias("text_key"))
    return per_text(keyed, lambda t: (fingerprint(t, shingle),), "fingerprint long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words, as polynomials over two, by the generator."""
    words = words.copy()
    for bit in range(_LENGTH - 1, 10, -1):
        words ^= ((words >> bit) & 1) * (_GENERATOR << (bit - 11))
    return words


class _Golay:
    """Nearest code words by table: each syndrome has one error of up to three bits."""

    def __init__(self) -> None:
        bits = 1 << np.arange(_LENGTH, dtype=np.int64)
        one, two = np.triu_indices(_LENGTH, 1)
        pairs = bits[one] | bits[two]
        three = (pairs[:, None] | bits).ravel()
        three = np.unique(three[np.bitwise_count(three) == 3])
        errors = np.concatenate([[0], bits, pairs, three])
        self.error = np.zeros(2048, np.int64)
        self.error[_syndromes(errors)] = errors
        self.low = _syndromes(np.arange(1 << 12))
        self.high = _syndromes(np.arange(1 << 11) << 12)

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12 information bits of the code word nearest to each word."""
        syndrome = self.low[words & 0xFFF] ^ self.high[words >> 12]
        return (words ^ self.error[syndrome]) >> 11

    def keys(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to six indices per word, and which of the six columns hold one."""
        flips = np.append(0, 1 << np.arange(width, dtype=np.int64))
        near = np.sort(self.index(words[:, None] ^ flips), axis=1)
        fresh = np.ones(near.shape, bool)
        fresh[:, 1:] = near[:, 1:] != near[:, :-1]
        place = np.cumsum(fresh, axis=1) - 1
        found = np.zeros((len(words), 6), np.int64)
        used = np.zeros((len(words), 6), bool)
        rows, columns = np.nonzero(fresh)
        found[rows, place[rows, columns]] = near[rows, columns]
        used[rows, place[rows, columns]] = True
        return found, used


def join_keys(prints: np.ndarray, golay: _Golay) -> tuple[np.ndarray, np.ndarray]:
    """Keys of signed fingerprints, with the position of each key's fingerprint."""
    whole = prints.view(np.uint64)
    parts = [
        ((whole >> np.uint64(start)) & np.uint64((1 << width) - 1)).astype(np.int64)
        for start, width in _SEGMENTS
    ]
    near = [golay.keys(p, width) for p, (_, width) in zip(parts, _SEGMENTS, strict=True)]
    keys, rows = [], []

    def add(kind: int, key: np.ndarray, used: np.ndarray) -> None:
        at, column = np.nonzero(used)
        keys.append(key[at, column] | (kind << 40))
        rows.append(at)

    kinds = ((i, j) for i in range(3) for j in range(3) if i != j)
    for kind, (i, j) in enumerate(kinds):
        add(kind, (parts[i][:, None] << 12) | near[j][0], near[j][1])
    (a, in_a), (b, in_b), (c, in_c) = near
    n = len(prints)
    ab = ((a[:, :, None] << 12) | b[:, None, :]).reshape(n, 36)
    in_ab = (in_a[:, :, None] & in_b[:, None, :]).reshape(n, 36)
    abc = ((ab[:, :, None] << 12) | c[:, None, :]).reshape(n, 216)
    add(6, abc, (in_ab[:, :, None] & in_c[:, None, :]).reshape(n, 216))
    return np.concatenate(keys), np.concatenate(rows)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    golay = _Golay()
    for batch in batches:
        prints = batch.column(0).to_numpy()
        for low in range(0, len(prints), 1000):
            some = prints[low : low + 1000]
            keys, rows = join_keys(some, golay)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(some[rows])], names=["key", "fingerprint"]
            )


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # Of a signed number, the bits of its absolute value would be counted.
    return np.bitwise_count((a ^ b).view(np.uint64))


def _spanning(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links of up to ``bits`` connect; fewer than fingerprints."""
    left, low, high = prints, [], []
    while len(left):
        todo, left = [left[:1]], left[1:]
        while todo and len(left):
            node, rest = todo[-1][0], todo[-1][1:]
            todo[-1:] = [rest] if len(rest) else []
            near = _distance(left, node) <= bits
            if near.any():
                found, left = left[near], left[~near]
                low.append(np.full(len(found), node))
                high.append(found)
                todo.append(found)
    if not low:
        return prints[:0], prints[:0]
    return np.concatenate(low), np.concatenate(high)


def _links(
    batches: Iterator[pa.RecordBatch], bits: int, block: int | None
) -> Iterator[pa.RecordBatch]:
    """Verified links among the fingerprints under each key; the rows come sorted by key.

    Keys with more than ``block`` fingerprints are passed on unread, with their key.
    """
    key, prints, over = np.empty(0, np.int64), np.empty(0, np.int64), None

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        none = pa.nulls(len(pairs), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["key", "a", "b"]
        )

    def passed(key: int, some: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some), key)), pa.array(some), pa.nulls(len(some), pa.int64())],
            names=["key", "a", "b"],
        )

    def linked(key: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        """For whole keys, all of them together."""
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        listed = np.repeat(sizes <= _LIST, sizes)
        a, b = [], []
        for step in range(1, _LIST):
            same = (key[step:] == key[:-step]) & listed[step:]
            one, two = prints[:-step][same], prints[step:][same]
            near = _distance(one, two) <= bits
            a.append(one[near])
            b.append(two[near])
        large = sizes > _LIST
        for start, size in zip(starts[large].tolist(), sizes[large].tolist(), strict=True):
            if block and size > block:
                yield passed(int(key[start]), prints[start : start + size])
            else:
                one, two = _spanning(np.unique(prints[start : start + size]), bits)
                a.append(one)
                b.append(two)
        if sum(map(len, a)):
            yield out(np.concatenate(a), np.concatenate(b))

    for batch in batches:
        if not batch.num_rows:
            continue
        new_key, new = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if over is not None:  # the rest of a key that is passed on
            rest = int(np.searchsorted(new_key, over, "right"))
            if rest:
                yield passed(over, new[:rest])
            if rest == len(new):
                continue
            new_key, new, over = new_key[rest:], new[rest:], None
        key, prints = np.append(key, new_key), np.append(prints, new)
        last = int(np.searchsorted(key, key[-1], "left"))
        if last:
            yield from linked(key[:last], prints[:last])
            key, prints = key[last:], prints[last:]
        if block and len(prints) > block:
            over = int(key[0])
            yield passed(over, prints)
            key, prints = key[:0], prints[:0]
    if len(key):
        yield from linked(key, prints)


_LINK_SCHEMA = "key long, a long, b long"


def _verified(keyed: DataFrame, bits: int, block: int | None) -> DataFrame:
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(lambda batches: _links(batches, bits, block), _LINK_SCHEMA)


def _in_blocks(large: DataFrame, block: int) -> DataFrame:
    """Large keys cut into parts by a hash; each two parts meet under a key of their own."""
    counts = large.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    parted = large.join(counts, "key").select(
        "key", "a", F.ceil(F.col("n") * 2 / block).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("a"), F.col("parts"))
    met = parted.select(
        "key", "a", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o")
    )
    key = F.xxhash64("key", F.least("part", "o"), F.greatest("part", "o"))
    return met.select(key.alias("key"), F.col("a").alias("fingerprint"))


def links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links between distinct ``fingerprint`` values that connect all in reach.

    All links of a small key are listed; of a larger one, as many as connect the
    same fingerprints. A key with more than ``block`` of them is compared in
    blocks, each a group of its own.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("three Golay segments find up to 4 differing bits")
    keyed = prints.select("fingerprint").distinct().mapInArrow(_keyed, "key long, fingerprint long")
    # These rows are two numbers each.
    with settings(prints.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": 20_000}):
        found = durable(_verified(keyed, max_bits, block), "simhash-links")
    pairs = found.where(F.col("key").isNull()).select("a", "b")
    large = found.where(F.col("key").isNotNull())
    if not large.isEmpty():
        more = _verified(_in_blocks(large, block), max_bits, None)
        pairs = pairs.unionByName(more.select("a", "b"))
    return pairs.distinct()


def _groups(prints: DataFrame, max_bits: int, block: int) -> DataFrame:
    """Per fingerprint its group, the first row of the fingerprint and of the group, and its rows.

    Rows without ``doc_id`` come after all others.
    """
    roots = connected(links(prints, max_bits, block)).select(
        F.col("node").alias("fingerprint"), "root"
    )
    roots = roots.unionByName(
        roots.select(F.col("root").alias("fingerprint"), "root").distinct()
    )
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    per_print = prints.groupBy("fingerprint").agg(
        F.min(row).alias("first"), F.count(F.lit(1)).alias("degree")
    )
    firsts = durable(per_print, "firsts")
    linked = firsts.join(roots, "fingerprint")
    best = linked.groupBy("root").agg(F.min("first").alias("best"))
    in_groups = linked.join(best, "root").select("fingerprint", "root", "best")
    return firsts.join(in_groups, "fingerprint", "left").select(
        "fingerprint",
        "first",
        "degree",
        F.coalesce("root", "fingerprint").alias("group"),
        F.coalesce("best", "first").alias("best"),
    )


def simhash_groups(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, fingerprint, component_id)``.

    ``component_id`` is the least ``doc_id`` that links of up to ``max_bits``
    differing bits reach, its own included. A null or empty text has
    fingerprint zero and is linked like any other. Repeated rows each get a
    row; a null ``doc_id`` counts as greater than any other, so a component has
    a null id only if all its rows do. Other columns of ``docs`` are ignored.
    """
    prints = durable(fingerprints(docs, shingle), "fingerprints")
    groups = durable(_groups(prints, max_bits, block), "groups")
    rows = groups.agg(F.sum("degree")).first()[0] or 0
    # Copies of a text and empty texts share a fingerprint: their rows do not move.
    return attach(prints, groups, "fingerprint", rows).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
    )


def near_distinct(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the one with the least id.

    All columns stay. Repeated rows of an id and text are copies like any other;
    which of them stays is open.
    """
    prints = durable(fingerprints(docs, shingle), "fingerprints")
    groups = _groups(prints, max_bits, block)
    first = groups.where(F.col("first") == F.col("best")).select("best.*")
    first = first.select(id_or_last().alias("id"), "text_key")
    # The join leaves the rows of an id together, so nothing moves again.
    kept = keyed(docs).join(first, ["id", "text_key"], "left_semi")
    return kept.dropDuplicates(["id", "text_key"]).select("row.*")
