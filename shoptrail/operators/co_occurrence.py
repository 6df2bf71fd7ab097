"""Items that the same users have: the most frequent item pairs, exactly.

Counting every pair of every user is quadratic in a user's items, and one user
may hold a third of the log. Exact steps keep it in bounds:

1. The most common items are counted among themselves. The ``top``-th count
   found is a floor: no pair below it can be in the answer. A pair is never
   more frequent than its rarer item, so items below the floor drop out.
2. Users with few items are counted as lists of pairs, which is linear in the
   log. That may raise the floor.
3. Users with many items are set aside while there are fewer of them than the
   floor: a pair that only they have stays below it. Each item gets a bitmap of
   those users, and two bitmaps give a pair's count among them, with none of
   their pairs ever listed.
4. Should more users be that large, the smaller of them are counted as lists
   cut into parts, each pair of parts a row of its own.
5. In a sparse log the floor is so low that few users or none may be set aside
   like that. Then the ``hot_users`` largest are, in another way: items that the
   same of these users have are a class, and a search over pairs of classes,
   best bound first, finds the first pairs that these users share most often.
   Those join the pairs that other users have. So these users cost their items
   and the pairs of their classes; further large users cost the square of their
   items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.constants import TOP_ITEM_PAIRS
from shoptrail.operators import pairs as pairs_module
from shoptrail.operators.pairs import attach, degrees, hot_keys, without, written_pairs
from shoptrail.operators.positions import with_position
from shoptrail.sources.durable import durable

# The longest list of items a task holds for one user.
LIST_ITEMS = 1000
# The most users that are set aside, which is the length of a bitmap.
HOT_USERS = 1024
# About the most pairs of items that one task counts; more pairs make more tasks.
TASK_PAIRS = 1 << 22
_OUT_ROWS = 1 << 16
_WORD_BITS = 64
# The most classes of items the driver compares; more are compared in a join.
LEADING_CLASSES = 1024
# The most classes with a common user that one group of that join holds.
CLASS_BLOCK = 2048


def item_co_occurrence(
    pairs: DataFrame,
    top: int = TOP_ITEM_PAIRS,
    list_items: int = LIST_ITEMS,
    hot_users: int = HOT_USERS,
) -> DataFrame:
    """The ``top`` item pairs by number of common users: ``(item_a, item_b, cnt)``.

    ``item_a`` precedes ``item_b`` in id order; equal counts rank by id. The
    last two arguments move work between the steps, never the result.
    """
    pairs = written_pairs(pairs)
    # Items are numbered in id order, so numbers compare and rank as ids do.
    items = durable(
        with_position(degrees(pairs, "item_id"), "item_id").withColumnRenamed(
            "position", "item"
        ),
        "items",
    )
    floor = _floor_of_common(pairs, items, top, list_items)
    frequent = items.where(F.col("degree") >= floor)
    kept = durable(
        attach(pairs, frequent, "item_id", pairs.count()).select("user_id", "item"),
        "frequent-pairs",
    )
    counts = _all_counts(kept, floor, top, list_items, hot_users)
    best = counts.orderBy(F.desc("cnt"), "a", "b").limit(top)
    return _with_ids(best, items, top).orderBy(F.desc("cnt"), "a", "b").select(
        "item_a", "item_b", "cnt"
    )


def _with_ids(best: DataFrame, items: DataFrame, top: int) -> DataFrame:
    """Item numbers of the answer, at most ``top`` rows, back to ids."""
    first = items.select(F.col("item").alias("a"), F.col("item_id").alias("item_a"))
    second = items.select(F.col("item").alias("b"), F.col("item_id").alias("item_b"))
    if top > pairs_module.BROADCAST_KEYS:
        return second.join(first.join(best, "a"), "b")
    return second.join(F.broadcast(first.join(F.broadcast(best), "a")), "b")


def _least_of_top(counts: DataFrame, top: int) -> int:
    """The ``top``-th largest count; 1 where there are fewer pairs."""
    best = counts.orderBy(F.desc("cnt")).limit(top)
    found, least = best.agg(F.count(F.lit(1)), F.min("cnt")).first()
    return least if found == top else 1


def _floor_of_common(pairs: DataFrame, items: DataFrame, top: int, list_items: int) -> int:
    """A count that at least ``top`` pairs reach.

    The number of items tried follows from ``top`` and ends at the longest
    list a task holds; with fewer items the floor is only lower.
    """
    tried = min(math.isqrt(8 * top) + 1, max(2, list_items))
    common = items.orderBy(F.desc("degree"), "item").limit(tried).select("item_id", "item")
    trial = pairs.join(F.broadcast(common), "item_id").select("user_id", "item")
    return _least_of_top(_count(_tails(_lists(trial), "items")), top)


def _all_counts(
    kept: DataFrame,
    floor: int,
    top: int,
    list_items: int,
    hot_users: int,
) -> DataFrame:
    """Users per item pair, ``(a, b, cnt)``, for all pairs that reach ``floor``."""
    large = durable(
        degrees(kept, "user_id").where(F.col("degree") > list_items), "large-users"
    )
    # One row: how many users have more items than each of the cuts.
    cuts = [list_items << i for i in range(40)]
    sizes = large.agg(*[F.count_if(F.col("degree") > c) for c in cuts]).first()
    if sizes[0] == 0:
        return _count_tails([_short(kept)], floor)

    rows = kept.count()
    short, middle = _short(without(kept, large, "user_id", rows)), None

    def counted(least: int) -> DataFrame:
        if middle is None:
            return _count_tails([short], least)
        return _count_cut_lists(short, middle, list_items, least)

    if sizes[0] > _may_set_aside(floor, hot_users):
        floor = max(floor, _least_of_top(_count_tails([short], floor), top))
    allowed = _may_set_aside(floor, hot_users)
    if sizes[0] > allowed and allowed < hot_users:
        by_class = min(hot_users, sizes[0])
        largest = durable(
            large.orderBy(F.desc("degree"), "user_id").limit(by_class), "largest-users"
        )
        if sizes[0] > by_class:
            others = large.join(F.broadcast(largest.select("user_id")), "user_id", "left_anti")
            middle = attach(kept, durable(others, "large-users"), "user_id", rows)
        masks, words = _bitmaps(kept, largest, by_class)
        # A pair that only these users have is theirs as often as it is found.
        alone = _best_of_classes(masks.where(_bits_in(words) >= floor), top)
        most = masks.agg(F.max(_bits_in(words))).first()[0] or 0
        counts = _add_shares(counted(floor - most), masks, words)
        # Of a pair that others have too, the larger count is the whole one.
        both = counts.where(F.col("cnt") >= floor).unionByName(_add_shares(alone, masks, words))
        return both.groupBy("a", "b").agg(F.max("cnt").alias("cnt")).where(F.col("cnt") >= floor)
    cut, hot_count = next((c, n) for c, n in zip(cuts, sizes, strict=True) if n <= allowed)
    if cut > list_items:
        middle = attach(kept, large.where(F.col("degree") <= cut), "user_id", rows)
    # A pair gains at most the number of hot users; rarer pairs are out.
    counts = counted(floor - hot_count)
    if hot_count:
        hot = large.where(F.col("degree") > cut)
        masks, words = _bitmaps(kept, hot, hot_count)
        counts = _add_shares(counts, masks, words)
    return counts.where(F.col("cnt") >= floor)


def _may_set_aside(floor: int, hot_users: int) -> int:
    """How many users may be: fewer than ``floor``, or their pairs could matter.

    Half of it, where possible, so that pairs which all others have less than
    half the floor times need no look-up.
    """
    return min(floor - 1, max(1, floor // 2), hot_users)


def _tails(lists: DataFrame, items: str) -> DataFrame:
    """Each item ``a`` of a sorted list with the items after it, as ``later``."""
    later = F.slice(items, F.col("i") + 2, F.size(items)).alias("later")
    return lists.select(F.posexplode(items).alias("i", "a"), items).select("a", later)


def _count(tails: DataFrame) -> DataFrame:
    return (
        tails.select("a", F.explode("later").alias("b"))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def _lists(pairs: DataFrame) -> DataFrame:
    """The sorted items of each user, of whom none has many."""
    return pairs.groupBy("user_id").agg(F.sort_array(F.collect_list("item")).alias("items"))


def _short(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tails of users whose lists are known to be short, and the pairs they start."""
    lists = durable(_lists(pairs), "lists")
    return _tails(lists, "items"), _starts(lists)


def _starts(lists: DataFrame) -> DataFrame:
    """Items ``a`` with the pairs they start, ``n``, in each list."""
    return lists.select(F.posexplode("items").alias("i", "a"), F.size("items").alias("n")).select(
        "a", (F.col("n") - 1 - F.col("i")).alias("n")
    )


def _hot_starts(lists: DataFrame) -> DataFrame:
    """Items ``a`` that start more pairs than one task should count."""
    return _work(_starts(lists))[0]


def _work(starts: DataFrame) -> tuple[DataFrame, int]:
    """The hot starts, and how many tasks count the others."""
    work = durable(starts.groupBy("a").agg(F.sum("n").alias("degree")), "work")
    total = work.agg(F.sum("degree")).first()[0] or 0
    tasks = max(pairs_module.partitions(work), math.ceil(total / TASK_PAIRS))
    return hot_keys(work, total, tasks).select("a"), tasks


def _count_tails(found: list[tuple[DataFrame, DataFrame]], least: int) -> DataFrame:
    """Users per item pair, for pairs that ``least`` or more users have.

    ``found`` has tails, and the pairs that their items start or some more.
    Pairs of an item that starts very many of them repeat within a task and
    combine there. Other pairs rarely do: their tails move whole, to where
    their first item is counted, which is a third of the bytes. What counts is
    the work, the pairs an item starts: there is a task for about every
    ``TASK_PAIRS`` of them, so that none holds more as the log grows.
    """
    tails, starts = (reduce(DataFrame.unionByName, dfs) for dfs in zip(*found, strict=True))
    hot, tasks = _work(starts)
    hot = F.broadcast(hot)
    cold = tails.join(hot, "a", "left_anti").where(F.size("later") > 0)
    counted = cold.repartition(tasks, "a").select("a", "later").mapInArrow(
        _counter(least), "a long, b long, cnt long"
    )
    repeated = _count(tails.join(hot, "a", "left_semi"))
    return repeated.where(F.col("cnt") >= least).unionByName(counted)


def _counter(least: int):
    """Counts the pairs of a task, which has all tails of its items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, sizes, later = [], [], []
        for batch in batches:
            lists = batch.column("later")
            firsts.append(batch.column("a").to_numpy())
            sizes.append(lists.value_lengths().to_numpy(zero_copy_only=False))
            later.append(lists.flatten().to_numpy())
        if not sum(map(len, later)):
            return
        items, rank = np.unique(np.concatenate(firsts), return_inverse=True)
        b = np.concatenate(later)
        low = b.min()
        # Ranks in a task are below 2**24 or so, which leaves room for 2**39 items.
        span = int(b.max() - low) + 1
        pairs = np.repeat(rank * span, np.concatenate(sizes)) + (b - low)
        del firsts, sizes, later, b
        pairs.sort()
        begins = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        counts = np.diff(np.r_[begins, len(pairs)])
        begins, counts = begins[counts >= least], counts[counts >= least]
        rank, b = np.divmod(pairs[begins], span)
        for at in range(0, len(counts), _OUT_ROWS):
            part = slice(at, at + _OUT_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[part], pa.int64()) for c in (items[rank], b + low, counts)],
                names=["a", "b", "cnt"],
            )

    return run


def _count_cut_lists(
    short: tuple[DataFrame, DataFrame], sized: DataFrame, list_items: int, least: int
) -> DataFrame:
    """``_count_tails`` of ``short`` and of users with many items.

    ``sized`` has each user's ``degree``.
    A user's items are hashed into parts of about half of ``list_items``. Each
    part meets each other part in one row, so that a large user is spread over
    as many rows as there are pairs of parts.
    """
    parts = F.ceil(F.col("degree") * 2 / list_items).cast("int")
    parted = sized.select("user_id", "item", parts.alias("parts")).select(
        "*", F.pmod(F.hash("item"), F.col("parts")).alias("part")
    )
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    met = parted.select("user_id", "item", "part", F.explode(every).alias("other"))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    lists = met.groupBy("user_id", low.alias("low"), high.alias("high")).agg(
        F.sort_array(F.collect_list(F.when(F.col("part") == low, F.col("item")))).alias("x"),
        F.sort_array(F.collect_list(F.when(F.col("part") != low, F.col("item")))).alias("y"),
    )
    lists = durable(lists, "cut-lists")
    own = lists.where(F.col("low") == F.col("high"))
    found = [short, (_tails(own, "x"), _starts(own.select(F.col("x").alias("items"))))]
    # Of two parts, an item of either starts the pairs with the later of the other.
    both = lists.where(F.col("low") < F.col("high"))
    for one, other in (("x", "y"), ("y", "x")):
        later = F.filter(other, lambda b: b > F.col("a")).alias("later")
        tails = both.select(F.explode(one).alias("a"), other).select("a", later)
        found.append((tails, both.select(F.explode(one).alias("a"), F.size(other).alias("n"))))
    return _count_tails(found, least)


def _bitmaps(kept: DataFrame, hot: DataFrame, hot_count: int) -> tuple[DataFrame, list[str]]:
    """Per item the ``hot`` users that have it, as bits of the named words.

    Low bits are users with few items.
    """
    # At most ``hot_users`` rows: one small window numbers them.
    number = F.row_number().over(Window.orderBy("degree", "user_id")) - 1
    bits = hot.select("user_id", number.alias("bit"))
    words = [f"w{i}" for i in range(math.ceil(hot_count / _WORD_BITS))]
    flag = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit") % _WORD_BITS)
    word = F.floor(F.col("bit") / _WORD_BITS)
    masks = durable(
        kept.join(F.broadcast(bits), "user_id")
        .groupBy("item")
        .agg(*[F.bit_or(F.when(word == i, flag).otherwise(0)).alias(w) for i, w in enumerate(words)]),
        "hot-bitmaps",
    )
    return masks, words


def _bits_in(words: list[str]) -> Column:
    return reduce(add, [F.bit_count(F.col(w)) for w in words])


def _add_shares(counts: DataFrame, masks: DataFrame, words: list[str]) -> DataFrame:
    """Add to each count the hot users that have both items."""
    left = masks.select(F.col("item").alias("a"), *[F.col(w).alias(f"a_{w}") for w in words])
    right = masks.select(F.col("item").alias("b"), *[F.col(w).alias(f"b_{w}") for w in words])
    shared = [
        F.coalesce(F.bit_count(F.col(f"a_{w}").bitwiseAND(F.col(f"b_{w}"))), F.lit(0))
        for w in words
    ]
    return (
        counts.join(left, "a", "left")
        .join(right, "b", "left")
        .select("a", "b", (F.col("cnt") + reduce(add, shared)).alias("cnt"))
    )


def _best_of_classes(masks: DataFrame, top: int) -> DataFrame:
    """The ``top`` pairs that most of a few users share: ``(a, b, cnt)``, ``cnt`` 0.

    ``masks`` has ``item`` and the words of its bitmap. Items with the same
    bitmap are a class, and all pairs of two classes have the same number of
    these users. Of such pairs those of low items come first: the pair of the
    r-th and the s-th item has r * s pairs, itself included, that do not come
    after it, so about top * log(top) can matter.
    """
    words = masks.columns[1:]
    classes = _classes(masks, words)
    pairs = durable(_best_class_pairs(classes, words, top), "class-pairs")
    ranked = durable(_first_items(masks, classes, pairs, words, top), "classes")
    r, same = F.col("r"), F.col("one") == F.col("two")
    first = F.when(same, r + 1).otherwise(1)
    last = F.floor(F.when(same, (top + r * (r + 1) / 2) / r).otherwise(top / r))
    last = F.least(last, "n_two").cast("int")
    partners = (
        ranked.withColumnRenamed("lead", "one")
        .join(_broadcast_if_small(pairs, top), "one")
        .where(first <= last)
        .select("item", "shared", "two", F.explode(F.sequence(first, last)).alias("s"))
    )
    other = ranked.select(
        F.col("lead").alias("two"), F.col("r").alias("s"), F.col("item").alias("other")
    )
    found_pairs = partners.join(other, ["two", "s"]).select(
        F.least("item", "other").alias("a"), F.greatest("item", "other").alias("b"), "shared"
    )
    best = found_pairs.orderBy(F.desc("shared"), "a", "b").limit(top)
    return best.select("a", "b", F.lit(0).cast("bigint").alias("cnt"))


def _broadcast_if_small(df: DataFrame, top: int) -> DataFrame:
    """``df``, of at most 2 * ``top`` rows, broadcast while that is few."""
    return F.broadcast(df) if 2 * top <= pairs_module.BROADCAST_KEYS else df


def _classes(masks: DataFrame, words: list[str]) -> DataFrame:
    """Per bitmap: items ``n``, users ``bits``, the two least items ``lead`` and ``second``.

    ``lead`` names the class. Both least items combine on the map side.
    """
    leads = masks.groupBy(*words).agg(F.count(F.lit(1)).alias("n"), F.min("item").alias("lead"))
    leads = durable(leads.withColumn("bits", _bits_in(words)), "class-leads")
    # A class of one has no pair of its own, and its second item is never asked for.
    several = leads.where(F.col("n") > 1).select(*words, "lead")
    rest = masks.join(several, words).where(F.col("item") > F.col("lead"))
    seconds = rest.groupBy("lead").agg(F.min("item").alias("second"))
    return durable(leads.join(seconds, "lead", "left"), "item-classes")


def _best_class_pairs(classes: DataFrame, words: list[str], top: int) -> DataFrame:
    """Pairs of classes that can have one of the ``top`` pairs: ``(one, two, shared, n_two)``.

    Two classes share at most the users of the smaller one, so classes are
    taken by their users, most first, until no later class can reach the count
    that ``top`` pairs have. The driver looks at ``LEADING_CLASSES`` at most.
    Are there more, their count is a floor for a join of all classes above it.
    A class pair whose first items come after those of ``top`` others has no
    pair to add, so at most ``top`` are returned.
    """
    head = classes.orderBy(F.desc("bits"), "lead").limit(LEADING_CLASSES + 1).collect()
    seen: list[tuple[int, int, int, int | None]] = []
    found, tally, floor = [], Counter(), 1
    for row in head[:LEADING_CLASSES]:
        if row["bits"] < floor:
            break
        mask = 0
        for w in reversed(words):
            mask = mask << _WORD_BITS | row[w] & (1 << _WORD_BITS) - 1
        seen.append((mask, row["n"], row["lead"], row["second"]))
        for other, m, lead, _ in seen:
            one, two = sorted((row["lead"], lead))
            shared = (mask & other).bit_count()
            pairs = row["n"] * m if one != two else m * (m - 1) // 2
            if pairs and shared >= floor:
                tally[shared] += pairs
                second = two if one != two else row["second"]
                found.append((-shared, one, second, two, m if two == lead else row["n"]))
        floor = max(floor, _level_of(tally, top))
    if len(seen) == LEADING_CLASSES < len(head) and head[-1]["bits"] >= floor:
        return _joined_class_pairs(classes, words, floor, top)
    best = sorted(found)[:top]
    return classes.sparkSession.createDataFrame(
        [(one, two, -less, n) for less, one, _, two, n in best if -less >= floor],
        "one long, two long, shared int, n_two long",
    )


def _level_of(tally: Counter, top: int) -> int:
    """The largest count that at least ``top`` pairs reach; 1 where there are fewer."""
    total = 0
    for shared in sorted(tally, reverse=True):
        total += tally[shared]
        if total >= top:
            return shared
    return 1


def _joined_class_pairs(
    classes: DataFrame, words: list[str], floor: int, top: int
) -> DataFrame:
    """The same from all classes with ``floor`` users or more.

    Classes that share ``floor`` users have one in common among the first
    ``bits - floor + 1`` of each, in the order of bits, so they meet at one of
    these, rare users first. Many classes at one user are compared in blocks.
    """
    near = classes.where(F.col("bits") >= floor)
    every = F.sequence(F.lit(0), F.lit(_WORD_BITS * len(words) - 1))
    users = F.filter(
        every,
        lambda b: F.getbit(
            F.get(F.array(*words), F.floor(b / _WORD_BITS).cast("int")), b % _WORD_BITS
        )
        == 1,
    )
    prefix = F.slice(users, 1, (F.col("bits") - floor + 1).cast("int"))
    at_user = durable(near.select("lead", "n", *words, F.explode(prefix).alias("bit")), "at-user")
    blocks = at_user.groupBy("bit").agg(
        F.ceil(F.count(F.lit(1)) / CLASS_BLOCK).cast("int").alias("blocks")
    )
    split = at_user.join(F.broadcast(blocks), "bit").withColumn(
        "block", F.pmod(F.hash("lead"), F.col("blocks"))
    )
    low = split.withColumn("high", F.explode(F.sequence("block", F.col("blocks") - 1)))
    high = split.withColumn("low", F.explode(F.sequence(F.lit(0), F.col("block"))))
    low = low.select(
        "bit", F.col("block").alias("low"), "high", F.col("lead").alias("x"),
        F.col("n").alias("n_x"), *[F.col(w).alias(f"x_{w}") for w in words],
    )
    high = high.select(
        "bit", "low", F.col("block").alias("high"), F.col("lead").alias("y"),
        F.col("n").alias("n_y"), *[F.col(w).alias(f"y_{w}") for w in words],
    )
    shared = reduce(
        add, [F.bit_count(F.col(f"x_{w}").bitwiseAND(F.col(f"y_{w}"))) for w in words]
    )
    met = low.join(high, ["bit", "low", "high"]).where(
        ((F.col("low") < F.col("high")) | (F.col("x") < F.col("y"))) & (shared >= floor)
    )
    one, two = F.least("x", "y"), F.greatest("x", "y")
    n_two = F.when(F.col("x") > F.col("y"), F.col("n_x")).otherwise(F.col("n_y"))
    across = met.select(
        one.alias("one"), two.alias("two"), shared.alias("shared"), n_two.alias("n_two"),
        two.alias("second"),
    ).dropDuplicates(["one", "two"])
    within = near.where(F.col("n") > 1).select(
        F.col("lead").alias("one"), F.col("lead").alias("two"), F.col("bits").alias("shared"),
        F.col("n").alias("n_two"), "second",
    )
    best = across.unionByName(within).orderBy(F.desc("shared"), "one", "second").limit(top)
    return best.select("one", "two", "shared", "n_two")


def _first_items(
    masks: DataFrame, classes: DataFrame, pairs: DataFrame, words: list[str], top: int
) -> DataFrame:
    """The first ``top + 1`` items of each class in ``pairs``: ``(lead, item, r)``.

    Items are numbers, so they are ranked within ranges of about a shuffle
    partition; sizes of a class's earlier ranges turn that into ranks in the
    class. No task sorts a whole class, and ranges past the last rank are not
    ranked at all.
    """
    asked = pairs.select(F.col("one").alias("lead")).union(pairs.select("two")).distinct()
    named = classes.join(_broadcast_if_small(asked, top), "lead", "left_semi")
    members = masks.join(_broadcast_if_small(named.select("lead", *words), top), words)
    parts = int(masks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = (masks.agg(F.max("item")).first()[0] or 0) // parts + 1
    ranged = durable(
        members.select("lead", "item", F.floor(F.col("item") / width).alias("range")), "members"
    )
    # One row per class and range.
    before = Window.partitionBy("lead").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = ranged.groupBy("lead", "range").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select(
        "lead", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    ).where(F.col("offset") <= top)
    rank = F.row_number().over(Window.partitionBy("lead", "range").orderBy("item"))
    return (
        ranged.join(offsets, ["lead", "range"])
        .select("lead", "item", (rank + F.col("offset")).alias("r"))
        .where(F.col("r") <= top + 1)
    )
