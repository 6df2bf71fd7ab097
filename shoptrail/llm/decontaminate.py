"""Training passages that copy test items, edited copies included.

Word n-grams of the test items are looked up in every text. All of them are
seeds, however frequent: which of them an edited copy leaves whole is not known
beforehand. Around a seed, passage and item are aligned by Smith-Waterman on
words, and the score, as a share of what the whole item would score against
itself, decides; or, for an excerpt of a long item, the score alone, if it is
that of ``EXCERPT`` matching words. A passage is as wide as any alignment that reaches the score,
and is not aligned where it has too few words of the item to reach it.

The test items are the small side. Their n-grams are broadcast, so no text moves
and no item gathers the documents that copy it. Beyond a bound on their size
the items are taken in parts, each a pass over the texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import LOWER, as_bytes, bound_batches, documents, send
from shoptrail.sources.durable import durable

NGRAM = 3
MIN_SCORE = 0.5
# An alignment that scores as this many matching words is a copy, however long the item.
EXCERPT = 50
# The most words of the items that are broadcast together; more are done in parts.
MOST_ITEM_WORDS = 5_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
_PUNCTUATION = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
# Cells of the tables that are filled at once.
_CELLS_AT_ONCE = 1 << 18


def words(text: bytes) -> list[bytes]:
    """Words in lower case (A to Z), without ASCII punctuation."""
    return text.translate(LOWER, _PUNCTUATION).split()


class Items:
    """The test items as word numbers, with their n-grams as sorted numbers."""

    def __init__(self, items: list[tuple[int, bytes]], n: int) -> None:
        self.n, self.ids, self.words, self.number = n, [], [], {}
        for item_id, text in items:
            found = words(text)
            if len(found) >= n:
                self.ids.append(item_id)
                for w in found:
                    self.number.setdefault(w, len(self.number) + 1)
                self.words.append(self.numbers(found))
        # Words of the passage at hand; all false between passages.
        self.here = np.zeros(len(self.number) + 1, bool)
        self.size = np.array([len(w) for w in self.words], np.int64)
        grams = [self.grams(w) for w in self.words] or [np.empty(0, np.int64)]
        gram = np.concatenate(grams)
        order = np.argsort(gram, kind="stable")
        self.gram = gram[order]
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.at = np.concatenate([np.arange(len(g)) for g in grams])[order]

    def numbers(self, found: list[bytes]) -> np.ndarray:
        """Numbers of words; 0 for a word no item has."""
        get = self.number.get
        return np.array([get(w, 0) for w in found], np.int64)

    def grams(self, numbers: np.ndarray) -> np.ndarray:
        """A number per n-gram; beyond 63 bits they wrap, and the alignment decides."""
        base = np.int64(len(self.number) + 1)
        gram = np.zeros(max(0, len(numbers) - self.n + 1), np.int64)
        for i in range(self.n):
            gram = gram * base + numbers[i : i + len(gram)]
        return gram

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in a text of n-grams that are known, and the n-grams."""
        last = max(0, len(numbers) - self.n + 1)
        inside = np.ones(last, bool)
        for i in range(self.n):
            inside &= numbers[i : i + last] > 0
        known = np.flatnonzero(inside)
        found = self.grams(numbers)[known]
        place = np.minimum(np.searchsorted(self.gram, found), max(0, len(self.gram) - 1))
        hit = self.gram[place] == found if len(self.gram) else np.zeros(len(found), bool)
        return known[hit], found[hit]

    def passages(self, numbers: np.ndarray, min_score: float) -> list[tuple[int, int, int]]:
        """``(item, start, end)`` of the passages around seeds that can reach ``min_score``."""
        position, gram = self.hits(numbers)
        if not len(position):
            return []
        first = np.searchsorted(self.gram, gram, "left")
        count = np.searchsorted(self.gram, gram, "right") - first
        which = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        item, start = self.item[which], np.repeat(position, count) - self.at[which]
        order = np.lexsort((start, item))
        item, start = item[order], start[order]
        size = self.size[item]
        # A whole item can lose so many words to gaps and still reach the score.
        least = np.minimum(min_score * size, EXCERPT)
        slack = np.maximum(4, np.ceil(MATCH * (size - least) / -GAP).astype(np.int64))
        # Seeds of an item on about the same diagonal share a passage.
        new = np.append(True, (item[1:] != item[:-1]) | (start[1:] - start[:-1] > slack[1:]))
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(item)) - 1
        low = np.maximum(0, start[at] - slack[at])
        high = np.minimum(len(numbers), start[last] + (size + slack)[at])
        found, here = [], self.here
        for i, start, end in zip(item[at].tolist(), low.tolist(), high.tolist(), strict=True):
            # No alignment matches more words of the item than the passage has.
            here[numbers[start:end]] = True
            most = np.count_nonzero(here[self.words[i]])
            here[numbers[start:end]] = False
            if most / len(self.words[i]) >= min_score or most >= EXCERPT:
                found.append((i, start, end))
        return found


def align(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments of rows of ``items`` with rows of ``passages``.

    Rows hold word numbers; -1 pads items and 0 is a word no item has. Returns
    the scores, and where in the passage each alignment starts and ends.
    """
    rows, width = passages.shape
    shift = np.arange(width + 1) * -GAP
    score = np.zeros((rows, width + 1), np.int64)
    start = np.broadcast_to(np.arange(width + 1), score.shape).copy()
    best = np.zeros(rows, np.int64)
    low, high = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    every = np.arange(rows)
    columns = np.arange(width + 1)
    for i in range(items.shape[1]):
        word = items[:, i : i + 1]
        gain = np.where((passages == word) & (word > 0), MATCH, MISMATCH)
        diagonal = score[:, :-1] + gain
        above = score[:, 1:] + GAP
        new = np.zeros_like(score)
        new_start = np.broadcast_to(columns, score.shape).copy()
        from_diagonal = (diagonal >= above) & (diagonal > 0)
        from_above = ~from_diagonal & (above > 0)
        new[:, 1:] = np.where(from_diagonal, diagonal, np.where(from_above, above, 0))
        new_start[:, 1:] = np.where(
            from_diagonal, start[:, :-1], np.where(from_above, start[:, 1:], columns[1:])
        )
        # A gap in the item: the best cell to the left, less its distance.
        reach = new + shift
        top = np.maximum.accumulate(reach, axis=1)
        here = np.where(reach == top, columns, 0)
        source = np.maximum.accumulate(here, axis=1)
        left = top - shift
        better = left > new
        new = np.where(better, left, new)
        new_start = np.where(better, np.take_along_axis(new_start, source, axis=1), new_start)
        pad = word < 0
        score, start = np.where(pad, score, new), np.where(pad, start, new_start)
        column = score.argmax(axis=1)
        higher = score[every, column] > best
        best = np.where(higher, score[every, column], best)
        low = np.where(higher, start[every, column], low)
        high = np.where(higher, column, high)
    return best, low, high


def _aligned(
    items: Items, found: list[tuple[int, int, int, int]], texts: dict[int, np.ndarray]
) -> Iterator[tuple[int, int, float, int, int]]:
    """``(row, item, score, start, end)`` for passages ``(row, item, start, end)``.

    Passages of about equal length are aligned together.
    """
    found = sorted(found, key=lambda f: (f[3] - f[2], len(items.words[f[1]])))
    while found:
        width = found[-1][3] - found[-1][2]
        n = max(1, _CELLS_AT_ONCE // max(1, width))
        some, found = found[-n:], found[:-n]
        longest = max(len(items.words[f[1]]) for f in some)
        one = np.full((len(some), longest), -1, np.int64)
        two = np.zeros((len(some), width), np.int64)
        for k, (row, item, low, high) in enumerate(some):
            one[k, : len(items.words[item])] = items.words[item]
            two[k, : high - low] = texts[row][low:high]
        for f, best, start, end in zip(some, *align(one, two), strict=True):
            share = int(best) / (MATCH * len(items.words[f[1]]))
            yield f[0], f[1], share, f[2] + int(start), f[2] + int(end)


def _copies(
    items: Items, texts: list[bytes | None], min_score: float
) -> dict[tuple[int, int], tuple[float, int, int]]:
    """The best passage for each (row, item) that reaches ``min_score`` or ``EXCERPT``."""
    found, kept = [], {}
    for row, text in enumerate(texts):
        numbers = items.numbers(words(text or b""))
        if passages := items.passages(numbers, min_score):
            kept[row] = numbers
            found += [(row, *p) for p in passages]
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for row, item, score, start, end in _aligned(items, found, kept):
        enough = score >= min_score or round(score * len(items.words[item]) * MATCH) >= MATCH * EXCERPT
        if enough and score > best.get((row, item), (0.0, 0, 0))[0]:
            best[row, item] = (score, start, end)
    return best


def _parts(docs: DataFrame, items: DataFrame, ngram: int) -> Iterator[Callable[[], Items]]:
    """The items with their n-grams, broadcast; more than one part if they are many.

    Items of ``8 * MOST_ITEM_WORDS`` bytes are one part. More are dealt to parts
    by a hash of their text, and one part at a time is with the driver. An item
    is in one part whole, so the parts' copies together are those of all items.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    known = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    known = known.where(F.col("text").isNotNull()).distinct()
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Twice as many parts as would do, as the hash does not deal evenly.
    parts = 1 if size <= 8 * MOST_ITEM_WORDS else 2 * math.ceil(size / (8 * MOST_ITEM_WORDS))
    part = F.pmod(F.xxhash64("text"), F.lit(parts))
    for n in range(parts):
        rows = (known if parts == 1 else known.where(part == n)).collect()
        rows = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield send(spark, Items([(item_id, text.encode()) for item_id, text in rows], ngram))


def short_items(items: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """The rows of ``items`` that match nothing: without a text, or with fewer than ``ngram`` words."""
    bound_batches(items.sparkSession)
    place = items.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(place))
            yield batch.filter(pa.array([len(words(t or b"")) < ngram for t in texts], pa.bool_()))

    return items.mapInArrow(run, items.schema)


def benchmark_copies(
    docs: DataFrame, items: DataFrame, ngram: int = NGRAM, min_score: float = MIN_SCORE
) -> DataFrame:
    """``(doc_id, item_id, score, start_word, end_word)``: passages that copy an item.

    ``score`` is 1 for a whole copy. It is less than ``min_score`` only for
    excerpts that score as ``EXCERPT`` matching words. Words are in lower case without ASCII
    punctuation; ``start_word`` and ``end_word`` (exclusive) count them from 0.
    Of several passages of a document the best one for an item is returned, the
    first of equal ones. Null or empty texts have no passage, items of fewer
    words than ``ngram`` or without a text match nothing (``short_items`` tells which). Repeated rows each
    get their own; other columns are ignored.
    """
    found: list[DataFrame] = []
    for sent in _parts(docs, items, ngram):
        if found:  # one part's items at a time with the executors
            found[-1] = durable(found[-1], "copies")
        found.append(_copies_of(docs, sent, min_score))
    return reduce(DataFrame.unionByName, found)


def _copies_of(docs: DataFrame, sent: Callable[[], Items], min_score: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = _copies(sent(), as_bytes(batch.column(1)), min_score)
            ids = batch.column(0).to_pylist()
            found = [
                (ids[row], sent().ids[item], *copies[row, item])
                for row, item in sorted(copies)
            ]
            if found:
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, kind) for v, kind in zip(zip(*found), kinds, strict=True)],
                    names=["doc_id", "item_id", "score", "start_word", "end_word"],
                )

    schema = "doc_id long, item_id long, score double, start_word long, end_word long"
    return documents(docs).mapInArrow(run, schema)


def without_copies(
    docs: DataFrame, items: DataFrame, ngram: int = NGRAM, min_score: float = MIN_SCORE
) -> DataFrame:
    """The rows of ``docs`` that copy no item, with all their columns. No row moves.

    Rows with null or empty texts stay, and repeated rows stay or go together.
    Without items all rows stay. Where the items are more than one broadcast
    holds, each part of them is a pass whose rows are written.
    """
    left = None
    for sent in _parts(docs, items, ngram):
        left = _clean_of(docs if left is None else durable(left, "clean"), sent, min_score)
    return left


def _clean_of(docs: DataFrame, sent: Callable[[], Items], min_score: float) -> DataFrame:
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copied = {row for row, _ in _copies(sent(), as_bytes(batch.column(place)), min_score)}
            yield batch.filter(pa.array([row not in copied for row in range(batch.num_rows)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
