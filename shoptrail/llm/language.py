"""Language identification by interpolated Kneser-Ney models of letters.

For each language, n-grams of letters of all its training documents are counted
on the executors. Counts turn into Kneser-Ney probabilities by plain
aggregations, and these into sorted arrays of n-gram hashes with the log
probability and the back-off weight of each. A text is scored under every
language by its cross-entropy per letter; the lowest wins.

Every counted n-gram is an entry, under its whole 64-bit hash. Models of up to
``MOST_ENTRIES`` entries and ``MOST_LANGUAGES`` languages are broadcast. Larger ones
stay a written table, and the distinct n-grams of the texts are joined to it;
both ways give the same results.

A text is rejected where its cross-entropy is far above what the training
documents of the language have, and nearer to what a foreign language has.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import documents, id_or_last, keyed, send, text_key
from shoptrail.operators.pairs import BROADCAST_KEYS
from shoptrail.sources.durable import durable

ORDER = 4
DISCOUNT = 0.75
# What is broadcast: 12 bytes an entry, and a pass over a text per language.
MOST_ENTRIES = 1 << 22
MOST_LANGUAGES = 64
UNKNOWN = "und"
# A text is rejected beyond this many standard deviations above the mean.
REJECT_FROM = 8.0
_LETTERS_AT_ONCE = 1 << 17
# Distinct n-grams of a language a task holds.
_MOST_HELD = 1 << 19
_SPACE = 32


class _Letters:
    """Texts as code points in lower case, with runs of anything else as one space."""

    def __init__(self) -> None:
        self.letter = np.zeros(0x110000, bool)
        for low in range(0, 0x110000, 0x1000):
            block = [chr(c).isalpha() for c in range(low, low + 0x1000)]
            self.letter[low : low + 0x1000] = block

    def __call__(self, text: str) -> np.ndarray:
        """Code points with a space at both ends; empty without any letter."""
        points = np.frombuffer(
            f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32
        )
        letter = self.letter[points]
        if not letter.any():
            return np.empty(0, np.uint32)
        points = np.where(letter, points, np.uint32(_SPACE))
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] = True
        return points[keep]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def gram_hashes(points: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """Per order 1 .. ``order`` a 64-bit hash of the n-gram that ends at each letter.

    Letters too near the start for an n-gram have the hash of the spaces before.
    """
    padded = np.concatenate([np.full(order - 1, _SPACE, np.uint64), points.astype(np.uint64)])
    hashes, h = [], np.zeros(len(points), np.uint64)
    for n in range(1, order + 1):
        # From the last letter backwards: the hash of a suffix is known by then.
        letter = padded[order - n : len(padded) - n + 1]
        h = _mixed(h * np.uint64(0x100000001B3) + letter + np.uint64(n))
        hashes.append(h)
    return hashes


_GRAMS = [f"g{n}" for n in range(1, ORDER + 1)]
# An n-gram is a letter after its context, the n - 1 letters before.
_CONTEXTS = [f"c{n}" for n in range(1, ORDER)]


def _ends(points: np.ndarray) -> np.ndarray:
    """Hashes of the n-grams that end at each letter but the first, then of the contexts."""
    grams = gram_hashes(points)
    return np.stack([g[1:] for g in grams] + [g[:-1] for g in grams[:-1]])


def _together(texts: Iterable[np.ndarray]) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """Texts with letters by their places and lengths, as many as make a good array.

    Only these are held as numbers at a time.
    """
    places, lengths, some, size = [], [], [], 0
    for place, points in enumerate(texts):
        if len(points) < 2:
            continue
        places.append(place)
        lengths.append(len(points) - 1)
        some.append(_ends(points))
        size += len(points)
        if size > _LETTERS_AT_ONCE:
            yield places, lengths, np.concatenate(some, axis=1)
            places, lengths, some, size = [], [], [], 0
    if some:
        yield places, lengths, np.concatenate(some, axis=1)


def _distinct(ends: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One column per distinct longest n-gram, with the sum of ``n``."""
    _, first, inverse = np.unique(ends[ORDER - 1], return_index=True, return_inverse=True)
    return ends[:, first], np.bincount(inverse, n, len(first)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of a task by language; more than fit well leave early."""
    letters = _Letters()
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows(lang: str) -> pa.RecordBatch:
        ends, n = held.pop(lang)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(n), pa.string()), pa.array(n)]
            + [pa.array(row.view(np.int64)) for row in ends],
            names=["lang", "n", *_GRAMS, *_CONTEXTS],
        )

    for batch in batches:
        by_lang: dict[str, list[int]] = {}
        for place, lang in enumerate(batch.column(0).to_pylist()):
            by_lang.setdefault(lang, []).append(place)
        for lang, places in by_lang.items():
            texts = (letters(batch.column(1)[p].as_py() or "") for p in places)
            for _, _, ends in _together(texts):
                ends, n = _distinct(ends, np.ones(ends.shape[1]))
                if lang in held:
                    ends = np.concatenate([held[lang][0], ends], axis=1)
                    ends, n = _distinct(ends, np.concatenate([held[lang][1], n]))
                held[lang] = ends, n
                if len(n) > _MOST_HELD:
                    yield rows(lang)
    for lang in sorted(held):
        yield rows(lang)


def _kneser_ney(counted: DataFrame) -> DataFrame:
    """``(lang, kind, n, gram, value)``: log probabilities and log back-off weights.

    ``counted`` has a row per language and longest n-gram. Shorter n-grams count
    by the number of different letters seen before them.
    """
    tables = {ORDER: counted.groupBy("lang", *_GRAMS, *_CONTEXTS).agg(F.sum("n").alias("n"))}
    for n in range(ORDER - 1, 0, -1):
        columns = ["lang", *_GRAMS[:n], *_CONTEXTS[: n - 1]]
        tables[n] = tables[n + 1].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    found, below = [], None
    for n in range(1, ORDER + 1):
        context = ["lang", *_CONTEXTS[n - 2 : n - 1]] if n > 1 else ["lang"]
        totals = tables[n].groupBy(*context).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("types")
        )
        weight = DISCOUNT * F.col("types") / F.col("total")
        rest = 1 / (F.col("types") + 1) if n == 1 else F.col("below")
        rows = tables[n].join(totals, context)
        if n > 1:
            rows = rows.join(below, ["lang", f"g{n - 1}"])
        p = (F.col("n") - DISCOUNT) / F.col("total") + weight * rest
        scored = durable(rows.withColumn("p", p), "probabilities")
        below = scored.select("lang", f"g{n}", F.col("p").alias("below"))
        found.append(_entries(scored, "p", n, f"g{n}", F.log("p")))
        # The context's own hash is that of an n-gram one shorter; of none it is 0.
        name = F.lit(0) if n == 1 else F.col(f"c{n - 1}")
        weights = totals.select("lang", name.cast("bigint").alias("c"), F.log(weight).alias("w"))
        found.append(_entries(weights, "w", n - 1, "c", F.col("w")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _entries(rows: DataFrame, kind: str, n: int, gram: str, value: Column) -> DataFrame:
    return rows.select(
        "lang",
        F.lit(kind).alias("kind"),
        F.lit(n).alias("n"),
        F.col(gram).alias("gram"),
        value.cast("float").alias("value"),
    )


@dataclass
class Models:
    """Per language, kind and order sorted hashes with their values."""

    languages: list[str]
    tables: dict[tuple[str, str, int], tuple[np.ndarray, np.ndarray]]
    unseen: dict[str, float]

    def _look_up(self, key: tuple[str, str, int], gram: np.ndarray, missing: float) -> np.ndarray:
        if key not in self.tables:
            return np.full(len(gram), missing)
        at, values = self.tables[key]
        place = np.minimum(np.searchsorted(at, gram), len(at) - 1)
        return np.where(at[place] == gram, values[place], missing)

    def log_probability(self, lang: str, ends: np.ndarray) -> np.ndarray:
        """Of the last letter of each longest n-gram, in nats."""
        ends = ends.view(np.int64)
        total = np.full(ends.shape[1], self.unseen[lang])
        for n in range(1, ORDER + 1):
            if n > 1:
                total = total + self._look_up((lang, "w", n - 1), ends[ORDER + n - 2], 0.0)
            p = self._look_up((lang, "p", n), ends[n - 1], np.nan)
            total = np.where(np.isnan(p), total, p)
        return total

    def cross_entropies(
        self, texts: Iterable[np.ndarray], n: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of ``n`` texts the nats per letter under each language, and the letters.

        The former are nan for a text without letters.
        """
        found, length = np.full((n, len(self.languages)), np.nan), np.zeros(n, np.int64)
        for places, lengths, ends in _together(texts):
            _, first, inverse = np.unique(ends[ORDER - 1], return_index=True, return_inverse=True)
            length[places] = lengths
            starts = np.cumsum(lengths) - lengths
            for k, lang in enumerate(self.languages):
                each = self.log_probability(lang, ends[:, first])[inverse]
                found[places, k] = -np.add.reduceat(each, starts) / lengths
        return found, length


@dataclass
class ModelTable:
    """What ``Models`` holds, as a written table, for more than is broadcast."""

    entries: DataFrame

    def unseen(self) -> DataFrame:
        """``(model, unseen)``, a row per language."""
        none = F.max(F.when(F.col("n") == 0, F.col("value").cast("double")))
        letters = F.count_if((F.col("kind") == "p") & (F.col("n") == 1))
        return self.entries.groupBy(F.col("lang").alias("model")).agg(
            (none - F.log(letters + 1)).alias("unseen")
        )

    def log_probabilities(self, seen: DataFrame) -> DataFrame:
        """``(g4, model, above)`` for the n-grams ``seen``: the log probability above ``unseen``.

        Languages that have no part of an n-gram are left out.
        """
        looked_up = [("p", n, g) for n, g in enumerate(_GRAMS, 1)]
        looked_up += [("w", n, c) for n, c in enumerate(_CONTEXTS, 1)]
        found = []
        for kind, n, column in looked_up:
            entries = self.entries.where((F.col("kind") == kind) & (F.col("n") == n))
            named = entries.select(F.col("gram").alias(column), F.col("lang").alias("model"), "value")
            found.append(
                seen.join(named, column).select(
                    _GRAMS[-1], "model", F.lit(f"{kind}{n}").alias("name"), "value"
                )
            )
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        by_name = every.groupBy(_GRAMS[-1], "model").agg(
            *[
                F.max(F.when(F.col("name") == name, F.col("value").cast("double"))).alias(name)
                for name in (f"{kind}{n}" for kind, n, _ in looked_up)
            ]
        )
        rows = by_name.join(self.unseen(), "model")
        total = F.coalesce("p1", "unseen")
        for n in range(2, ORDER + 1):
            total = F.coalesce(F.col(f"p{n}"), total + F.coalesce(F.col(f"w{n - 1}"), F.lit(0.0)))
        return rows.select(_GRAMS[-1], "model", (total - F.col("unseen")).alias("above"))


def train(docs: DataFrame) -> Models | ModelTable:
    """Models of the languages in ``lang`` of ``docs``; rows without one are left out."""
    labelled = docs.select(F.col("lang").cast("string"), F.col("text").cast("string")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    schema = ", ".join(["lang string", "n long", *(f"{c} long" for c in (*_GRAMS, *_CONTEXTS))])
    counted = durable(labelled.mapInArrow(_count, schema), "ngrams")
    every = durable(_kneser_ney(counted), "models")
    # Each language has one weight of letters never seen.
    size = every.agg(F.count(F.lit(1)), F.count_if(F.col("n") == 0)).first()
    if size[0] > MOST_ENTRIES or size[1] > MOST_LANGUAGES:
        return ModelTable(every)
    languages = sorted(r[0] for r in every.where("n = 0").select("lang").collect())
    return _models(languages, every.orderBy("lang", "kind", "n", "gram").toArrow())


def _models(languages: list[str], every: pa.Table) -> Models:
    if not languages:
        return Models([], {}, {})
    lang = every.column("lang").to_numpy(zero_copy_only=False).astype(str)
    kind = every.column("kind").to_numpy(zero_copy_only=False).astype(str)
    n, gram = every.column("n").to_numpy(), every.column("gram").to_numpy()
    value = every.column("value").to_numpy()
    new = np.append(True, (lang[1:] != lang[:-1]) | (kind[1:] != kind[:-1]) | (n[1:] != n[:-1]))
    tables, unseen = {}, {}
    starts = np.flatnonzero(new)
    for low, high in zip(starts, np.append(starts[1:], len(n)), strict=True):
        key = (str(lang[low]), str(kind[low]), int(n[low]))
        tables[key] = gram[low:high], value[low:high]
    for one in languages:
        # The weight of letters never seen, shared with one letter more than were.
        letters = len(tables[one, "p", 1][0])
        unseen[one] = float(tables.pop((one, "w", 0))[1][0]) - math.log(letters + 1)
    return Models(languages, tables, unseen)


def in_training(doc_id: str = "doc_id") -> Column:
    """Two thirds of the documents, by a checksum of the id; rows without an id are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(False))


def _scored(docs: DataFrame, models: Models | ModelTable) -> DataFrame:
    """``docs`` without its text, with the best language, its cross-entropy and the score."""
    if isinstance(models, ModelTable):
        return _scored_by_join(docs, models)
    sent = send(docs.sparkSession, models)
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _Letters()
        languages = np.array([*sent().languages, UNKNOWN], object)
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            texts = (letters(t.as_py() or "") for t in batch.column("text"))
            found, length = sent().cross_entropies(texts, n)
            any_ = ~np.isnan(found).any(axis=1) & (found.shape[1] > 0)
            best = np.full(n, len(languages) - 1)
            lowest, score, second = np.zeros(n), np.zeros(n), np.full(n, np.nan)
            if any_.any():
                some = found[any_]
                best[any_], lowest[any_] = some.argmin(axis=1), some.min(axis=1)
                if some.shape[1] > 1:
                    second[any_] = np.partition(some, 1, axis=1)[:, 1]
                odds = (some - some.min(axis=1, keepdims=True)) * np.minimum(length[any_], 50)[:, None]
                score[any_] = 1 / np.exp(-odds).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [
                    pa.array(languages[best].tolist(), pa.string()),
                    pa.array(np.where(any_, lowest, np.nan), from_pandas=True),
                    pa.array(second, from_pandas=True),
                    pa.array(length),
                    pa.array(score),
                ],
                names=[*kept, "lang_pred", "cross_entropy", "second", "letters", "score"],
            )

    before = ", ".join(f"{name} {kind}" for name, kind in docs.select(*kept).dtypes)
    more = "lang_pred string, cross_entropy double, second double, letters long, score double"
    return docs.mapInArrow(run, f"{before}, {more}")


def _grams_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` without its text as ``row`` and ``letters``, and ``(row, times, ...)`` of its n-grams."""
    kept = [c for c in docs.columns if c != "text"]
    ends_of = [*_GRAMS, *_CONTEXTS]
    numbers = ["row", "letters", "times", *ends_of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _Letters()
        for batch in batches:
            row, length = batch.column("row").to_numpy(), np.zeros(batch.num_rows, np.int64)
            texts = (letters(t.as_py() or "") for t in batch.column("text"))
            for places, lengths, ends in _together(texts):
                length[places] = lengths
                place = np.repeat(places, lengths)
                order = np.lexsort((ends[ORDER - 1], place))
                place, ends = place[order], ends[:, order].view(np.int64)
                last = ends[ORDER - 1]
                new = np.append(True, (place[1:] != place[:-1]) | (last[1:] != last[:-1]))
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(place)))
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(at), batch.schema.field(c).type) for c in kept]
                    + [pa.array(row[place[at]]), pa.nulls(len(at), pa.int64()), pa.array(times)]
                    + [pa.array(e[at]) for e in ends],
                    names=[*kept, *numbers],
                )
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [batch.column("row"), pa.array(length), none]
                + [none] * len(ends_of),
                names=[*kept, *numbers],
            )

    before = ", ".join(f"{name} {kind}" for name, kind in docs.select(*kept).dtypes)
    schema = ", ".join([before, *(f"{c} long" for c in numbers)])
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    both = durable(numbered.mapInArrow(run, schema), "grams")
    texts = both.where(F.col("times").isNull()).select(*kept, "row", "letters")
    return texts, both.where(F.col("times").isNotNull()).select("row", "times", *ends_of)


def _scored_by_join(docs: DataFrame, models: ModelTable) -> DataFrame:
    """``_scored`` with the models as a table."""
    texts, grams = _grams_of(docs)
    seen = durable(grams.select(*_GRAMS, *_CONTEXTS).distinct(), "distinct")
    above = models.log_probabilities(seen)
    # Every language has the space all texts end with, so each text meets all of them.
    sums = (
        grams.select("row", "times", _GRAMS[-1])
        .join(above, _GRAMS[-1])
        .groupBy("row", "model")
        .agg(F.sum(F.col("times") * F.col("above")).alias("above"))
    )
    entropy = -(F.col("unseen") + F.col("above") / F.col("letters"))
    each = (
        sums.join(models.unseen(), "model")
        .join(texts.select("row", "letters"), "row")
        .select("row", "letters", F.struct(entropy.alias("h"), "model").alias("one"))
    )
    ordered = each.groupBy("row").agg(
        F.sort_array(F.collect_list("one")).alias("every"),
        F.least(F.max("letters"), F.lit(50)).alias("most"),
    )
    first, second = F.get("every", F.lit(0)), F.get("every", F.lit(1))
    odds = F.aggregate(
        "every",
        F.lit(0.0),
        lambda total, one: total + F.exp((first["h"] - one["h"]) * F.col("most")),
    )
    best = ordered.select(
        "row",
        first["model"].alias("lang_pred"),
        first["h"].alias("cross_entropy"),
        second["h"].alias("second"),
        (1 / odds).alias("score"),
    )
    return texts.join(best, "row", "left").select(
        *[c for c in docs.columns if c != "text"],
        F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
        "cross_entropy",
        "second",
        "letters",
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _limits(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The greatest cross-entropies that are accepted, per language and at each length.

    Per language it is the middle between what its training documents have and
    what the next best language would give them, or more where their spread
    asks for it, as it does at some lengths. At most 64 rows a language.
    """
    right = scored.where(F.col("training") & (F.col("lang") == F.col("lang_pred")))
    spread = F.avg("cross_entropy") + REJECT_FROM * F.stddev_pop("cross_entropy")
    middle = (F.avg("cross_entropy") + F.avg("second")) / 2
    at_any = right.groupBy("lang_pred").agg(F.greatest(spread, middle).alias("at_any"))
    at_length = right.groupBy("lang_pred", "length").agg(spread.alias("at_length"))
    return at_any, at_length


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, cross_entropy, accepted)`` per row.

    Models and limits are learnt from rows with a ``lang`` whose
    ``crc32(doc_id)`` mod 3 is not 1. ``lang_pred`` is the language with the
    lowest cross-entropy per letter, the first in order of equal ones, or
    ``und`` for a text without letters or without any model. ``score`` compares
    it with the other languages, 1 being certain; ``und`` scores 0. A document
    is not accepted if it is ``und`` or far less like its language than the
    training documents. Rows without an id are neither learnt from nor held out.
    Repeated rows count as often as they occur; texts count whole, and other
    columns of ``docs`` are ignored.
    """
    return _identified(docs).drop("text_key")


def _identified(docs: DataFrame) -> DataFrame:
    rows = documents(
        docs,
        F.col("lang").cast("string"),
        in_training().alias("training"),
        text_key().alias("text_key"),
    )
    models = train(rows.where("training"))
    length = F.floor(F.log2(F.col("letters") + 1)).cast("int").alias("length")
    scored = durable(_scored(rows, models).select("*", length), "languages")
    at_any, at_length = _limits(scored)
    if isinstance(models, Models):
        at_any, at_length = F.broadcast(at_any), F.broadcast(at_length)
    limited = scored.join(at_any, "lang_pred", "left").join(
        at_length, ["lang_pred", "length"], "left"
    )
    limit = F.greatest("at_any", "at_length")
    fits = F.coalesce(F.col("cross_entropy") <= limit, F.lit(True))
    return limited.select(
        "doc_id",
        "text_key",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "cross_entropy",
        ((F.col("lang_pred") != UNKNOWN) & fits).alias("accepted"),
    )


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns."""
    rejected = durable(
        _identified(docs)
        .where(~F.col("accepted"))
        .select(id_or_last().alias("id"), "text_key")
        .distinct(),
        "rejected",
    )
    few = F.broadcast(rejected) if rejected.count() <= BROADCAST_KEYS else rejected
    return keyed(docs).join(few, ["id", "text_key"], "left_anti").select("row.*")
