"""Mixing sources to target weights by pivotal rounding.

Every document of a source is wanted the same number of times, mostly not a
whole number. The whole part is certain. The fractions are rounded in pairs: of
two fractional documents one takes mass from the other, at random and without
bias, until one of them is 0 or 1, and the other goes on to the next pair. The
mass is words, so the words taken from a source stay what they were until one
document is left. That one is rounded to the nearest whole copy, and smaller ones are
rounded the other way to make up for it: a source misses its target by about half the
words of a small document.

The pairs form a tree. Documents of a source and size class are dealt to blocks
of some hundred by a hash of their id; a block leaves one fractional document,
and these are dealt to blocks again. Some documents of every source, by a hash, wait
(of a small source all): at the end the leftovers of the classes are carried down
through them, from the largest to the smallest, so that a large leftover meets the
mass it needs to be finished and what is left over at last is small. All draws are
hashes of ids, so every run gives the same result whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import documents, id_or_last, keyed
from shoptrail.operators.pairs import BROADCAST_KEYS
from shoptrail.operators.positions import numbered
from shoptrail.sources.durable import durable

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = 42
# Documents paired in one block.
BLOCK = 128
# Documents of a source, about as many, that wait for what the blocks leave.
RESERVE = 512
# Size classes per doubling of the size.
_CLASSES = 8
_TINY = 1e-9


def n_words(text: Column) -> Column:
    """Number of runs without blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_copies: float = MOST_COPIES
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    Sources in code-point order, null last, have the ``weights`` in turn and
    share all sizes by them. A target stops at ``most_copies`` times the size of
    its source, and what it leaves goes to the others by weight: the level, words
    per weight, rises from round to round until no further source is above its cap.
    A round is one aggregation of a row per source; sources are numbered by a
    distributed sort. No sources, or sources without words, give targets of 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.col("position") % len(weights)
    weighted = durable(
        numbered(totals, F.asc_nulls_last("source")).select(
            "source",
            "source_size",
            F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
            (F.col("source_size") * float(most_copies)).alias("cap"),
        ),
        "weighted-sources",
    )
    every = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (every[0] or 0) / (every[1] or 1.0)
    capped = 0
    while True:
        above = F.col("cap") < F.col("weight") * F.lit(level)
        # Sums of whole numbers, the same in any order.
        n, size, weight = weighted.agg(
            F.count_if(above),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.sum(F.when(~above, F.col("weight"))),
        ).first()
        if n == capped or not weight:
            break
        capped, level = n, (every[0] - most_copies * size) / weight
    return weighted.select(
        "source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target")
    )


def _units(docs: DataFrame) -> DataFrame:
    """Rows with equal id, source and size, ``n`` of them, are taken together."""
    rows = documents(docs, F.col("source").cast("string")).select(
        "doc_id", "source", n_words(F.col("text")).alias("size")
    )
    return rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))


def _source_table(units: DataFrame, weights: tuple[float, ...], most_copies: float) -> DataFrame:
    """Targets, with the number of blocks of each size class of the source."""
    sizes = units.select("source", (F.col("size") * F.col("n")).alias("size"), _class())
    wanted = targets(sizes.select("source", "size"), weights, most_copies)
    blocks = sizes.groupBy("source", "class").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"), F.count(F.lit(1)).alias("units")
    )
    by_class = blocks.groupBy("source").agg(
        F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("blocks"),
        F.sum("units").alias("units"),
    )
    renamed = by_class.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    return wanted.join(renamed, same).drop("_source")


def _class() -> Column:
    return F.floor(F.log2(F.col("size") + 1) * _CLASSES).cast("int").alias("class")


def _draw(seed: int, level: int) -> Column:
    """A number from 0 to 1 that follows from the document alone."""
    h = F.xxhash64(F.lit(seed), F.lit(level), F.col("doc_id"), F.col("source"), F.col("size"))
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def _pair(state: Column, item: Column) -> Column:
    """One pair: words move between the two until one is taken 0 or 1 times.

    The state has the fractional document so far and those rounded already.
    Either of two moves leaves the words as they are: up, the first document
    gains what the second loses, or down. Their odds are such that both
    documents keep their expected copies.
    """
    one, p, q, s, t = state["left"], state["left"]["p"], item["p"], state["left"]["words"], item["words"]
    up, down = F.least((1 - p) * s, q * t), F.least(p * s, (1 - q) * t)
    goes_up = item["u"] * (up + down) < down
    first_done = F.when(goes_up, (1 - p) * s <= q * t).otherwise(p * s <= (1 - q) * t)
    moved = F.when(goes_up, up).otherwise(-down)
    rest = F.when(first_done, q - moved / t).otherwise(p + moved / s)
    return F.struct(
        F.struct(
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), rest)).alias("p"),
            F.when(first_done, t).otherwise(s).alias("words"),
            F.when(first_done, item["id"]).otherwise(one["id"]).alias("id"),
        ).alias("left"),
        F.concat(
            state["done"],
            F.array(
                F.struct(
                    F.when(first_done, one["id"]).otherwise(item["id"]).alias("id"),
                    F.when(first_done, s).otherwise(t).alias("words"),
                    (goes_up == first_done).alias("taken"),
                )
            ),
        ).alias("done"),
    )


def _round(items: DataFrame, keys: list[str], seed: int, level: int) -> DataFrame:
    """Each group of ``keys`` down to one fractional document, large ones first.

    ``done`` has the others, rounded; ``left`` the one that goes on.
    """
    unit = F.struct("doc_id", "source", "size").alias("id")
    words = F.greatest("words", F.lit(1)).cast("double").alias("words")
    draw = _draw(seed, level).alias("u")
    row = F.struct((-F.col("words")).alias("order"), draw, words, "p", unit)
    groups = items.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("items"))
    first = F.get("items", F.lit(0))
    none = F.transform(
        F.slice("items", 1, 0),
        lambda i: F.struct(i["id"].alias("id"), i["words"].alias("words"), F.lit(False).alias("taken")),
    )
    start = F.struct(
        F.struct(*[first[c].alias(c) for c in ("p", "words", "id")]).alias("left"),
        none.alias("done"),
    )
    others = F.slice("items", F.lit(2), F.size("items"))
    return groups.select(*keys, F.aggregate(others, start, _pair).alias("s")).select(
        *keys, "s.left", "s.done"
    )


def _corrected(rounds: DataFrame) -> DataFrame:
    """The last round, where rounding what is left over is made good by smaller documents.

    Rounding a fraction adds or takes words. From the largest document of the group to the
    smallest, one is rounded the other way where that brings the words nearer to what they
    were. So a source misses its target by about half of a small document.
    """
    left = F.col("left")
    wanted = F.when(left["p"] >= 0.5, 1 - left["p"]).otherwise(-left["p"]) * left["words"]
    ordered = F.sort_array(
        F.transform(
            "done",
            lambda d: F.struct(
                (-d["words"]).alias("order"), d["id"].alias("id"), d["words"].alias("words"),
                d["taken"].alias("taken"),
            ),
        )
    )

    def turn(state: Column, d: Column) -> Column:
        off = state["off"] + F.when(d["taken"], -d["words"]).otherwise(d["words"])
        nearer = F.abs(off) < F.abs(state["off"])
        now = F.struct(d["id"].alias("id"), d["words"].alias("words"), (d["taken"] != nearer).alias("taken"))
        return F.struct(
            F.when(nearer, off).otherwise(state["off"]).alias("off"),
            F.concat(state["done"], F.array(now)).alias("done"),
        )

    start = F.struct(wanted.alias("off"), F.slice("done", 1, 0).alias("done"))
    return rounds.withColumn("done", F.aggregate(ordered, start, turn)["done"])


def _rounded(rounds: DataFrame) -> DataFrame:
    return rounds.select(F.explode("done").alias("d")).select("d.id.*", "d.taken")


def _going(rounds: DataFrame, *keys: str | Column) -> DataFrame:
    return rounds.select(*keys, "left.id.*", "left.p", "left.words")


def _round_fractions(items: DataFrame, most_blocks: int, seed: int) -> DataFrame:
    """``(doc_id, source, size, taken)`` for ``items`` with fraction ``p`` and block keys.

    The tree first joins the blocks of a size class, as many rounds as the most
    blocks ask for, then the size classes of a source and what was in ``reserve``.
    """
    keys = ["source", "class", "block"]
    reserve = items.where("reserve").select("doc_id", "source", "size", "p", "words")
    items = items.where("not reserve").drop("reserve")
    found, level = [], 0
    while True:
        rounds = _round(items, keys, seed, level)
        rounds = durable(rounds if "class" in keys else _corrected(rounds), "rounds")
        found.append(_rounded(rounds))
        level += 1
        if most_blocks > 1:
            most_blocks = -(-most_blocks // BLOCK)
            block = F.floor(F.col("block") / BLOCK).alias("block")
            items = _going(rounds, F.col("class"), block)
        elif "class" in keys:
            keys = ["source"]
            items = _going(rounds).unionByName(reserve)
        else:
            break
    taken = (F.col("p") >= 0.5).alias("taken")
    found.append(_going(rounds).select("doc_id", "source", "size", taken))
    rounded = found[0]
    for more in found[1:]:
        rounded = rounded.unionByName(more)
    return rounded


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most_copies: float = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, source, size, n, source_size, target, copies)``: how often to take what.

    The size of a document is its number of words. ``n`` rows with equal id,
    source and size are one unit, and each of them is taken ``copies`` times.
    Null text has size 0, null sources are a source of their own, null ids are
    ids like others. Documents of size 0 are rounded like any. An empty table
    gives an empty result. Other columns of ``docs`` are ignored.
    """
    units = durable(_units(docs), "units")
    table = durable(_source_table(units, weights, most_copies), "sources")
    known = table.withColumnRenamed("source", "_source")
    if table.count() <= BROADCAST_KEYS:
        known = F.broadcast(known)
    wish = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    near = F.when(F.abs(wish - F.round(wish)) < _TINY, F.round(wish)).otherwise(wish)
    wanted = units.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    wanted = wanted.select("*", _class(), near.alias("wish")).select(
        "*", F.floor("wish").alias("sure"), (F.col("wish") - F.floor("wish")).alias("p")
    )
    dealt = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("size"))
    waits = F.xxhash64(F.lit(seed), F.lit("reserve"), F.col("doc_id"), F.col("size"))
    items = wanted.where(F.col("p") > 0).select(
        (F.pmod(waits, F.col("units")) < RESERVE).alias("reserve"),
        "source",
        "class",
        F.pmod(dealt, F.element_at("blocks", F.col("class"))).alias("block"),
        "doc_id",
        "size",
        "p",
        (F.col("size") * F.col("n")).alias("words"),
    )
    most = table.agg(F.max(F.array_max(F.map_values("blocks")))).first()[0] or 1
    rounded = _round_fractions(items, most, seed)
    unit = ("doc_id", "source", "size")
    sure = wanted.select(*unit, "n", "source_size", "target", F.col("sure").alias("copies"))
    extra = rounded.select(*unit, F.col("taken").cast("bigint").alias("copies"))
    return (
        sure.unionByName(extra, allowMissingColumns=True)
        .groupBy(*unit)
        .agg(
            *[F.max(c).alias(c) for c in ("n", "source_size", "target")],
            F.sum("copies").alias("copies"),
        )
    )


def mixed(docs: DataFrame, **wishes) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it."""
    # A missing source is in words the join can hash, and like no other.
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    taken = mix(docs, **wishes).where(F.col("copies") > 0)
    taken = taken.select(id_or_last().alias("id"), source.alias("from"), "size", "copies")
    rows = keyed(docs, **{"from": source, "size": n_words(F.col("text").cast("string"))})
    copies = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return rows.join(taken, ["id", "from", "size"]).select("row", copies).select("row.*")
