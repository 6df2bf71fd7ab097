"""Quality scores by a generalised additive model with pairwise interactions.

Features are cut into bins. Shallow trees are boosted in turn, feature by
feature, each seeing one feature only; all trees of a feature add up to one look-up
table over its bins. Then the pairs of features that explain most of what is left
get tables of their own, boosted the same way. A score is a sum of look-ups.

Features of all documents are counted on the executors. The model is fitted on
the driver to a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import documents, per_text
from shoptrail.llm.quality_rules import base_counts, rule_values
from shoptrail.sources.durable import durable

# The most labelled rows the model is fitted to, those with the least hashes.
MOST_LABELLED = 20_000
PREDICT_FROM = 0.3
BINS, PAIR_BINS = 64, 16
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE, RIDGE, LEAST_WEIGHT = 0.1, 1.0, 1.0


def features(text: bytes) -> list[float]:
    """What the model looks at; 0 where a text has nothing to count."""
    words = text.split()
    base = base_counts(text, words)
    values = rule_values(text, words, base)[1:]
    n, size = max(1, len(words)), max(1, len(text))
    digits = sum(map(text.count, b"0123456789"))
    return [
        *values,
        math.log1p(len(words)),
        math.log1p(len(text) / (text.count(b"\n") + 1)),
        digits / size,
        sum(text.count(c) for c in b".,;:") / n,
        text.count(b"|") / n,
        sum(map(text.count, (b"http", b"www.", b"@"))) / n,
    ]


@dataclass
class Model:
    """Look-up tables: per feature over its bins, per pair over coarser bins."""

    intercept: float
    cuts: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for rows of features."""
        total = np.full(len(x), self.intercept)
        coarse = {}
        for i, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, i], "right")]
        for i in {k for a, b, _ in self.pairs for k in (a, b)}:
            coarse[i] = np.searchsorted(self.pair_cuts[i], x[:, i], "right")
        for a, b, table in self.pairs:
            total += table[coarse[a], coarse[b]]
        return _sigmoid(total)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _best_split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut between neighbouring bins, and the bins left of it."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = (
        left_g**2 / (left_h + RIDGE)
        + right_g**2 / (right_h + RIDGE)
        - all_g**2 / (all_h + RIDGE)
    )
    gain = np.where((left_h >= LEAST_WEIGHT) & (right_h >= LEAST_WEIGHT), gain, 0.0)
    if not len(gain) or gain.max() <= 0:
        return 0.0, 0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Values per bin of a tree with up to ``leaves`` leaves, by the largest gains."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, at, k = max(
            (*_best_split(g[low:high], h[low:high]), k) for k, (low, high) in enumerate(parts)
        )
        if gain <= 0:
            break
        low, high = parts[k]
        parts[k : k + 1] = [(low, low + at), (low + at, high)]
    values = np.zeros(len(g))
    for low, high in parts:
        values[low:high] = g[low:high].sum() / (h[low:high].sum() + RIDGE)
    return values


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the better tree: one cut of a feature, then of the other in each half."""
    best = (0.0, np.zeros(g.shape))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        _, at = _best_split(a.sum(axis=1), b.sum(axis=1))
        at = at or len(a) // 2
        values, gain = np.zeros(a.shape), 0.0
        for half in (slice(0, at), slice(at, len(a))):
            one, two = a[half].sum(axis=0), b[half].sum(axis=0)
            low = _tree(one, two, leaves=2)
            gain += float((low * one).sum())
            values[half] = low
        if gain > best[0]:
            best = (gain, values.T if turned else values)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """The model for rows of features and labels 0 or 1; without rows it scores 0.5."""
    width = x.shape[1]
    mean = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(mean / (1 - mean)))
    if not len(y):
        none = [np.empty(0)] * width
        return Model(start, none, none, [np.zeros(1)] * width, [])
    cuts = [_cuts(x[:, i], BINS) for i in range(width)]
    pair_cuts = [_cuts(x[:, i], PAIR_BINS) for i in range(width)]
    bins = [np.searchsorted(c, x[:, i], "right") for i, c in enumerate(cuts)]
    coarse = [np.searchsorted(c, x[:, i], "right") for i, c in enumerate(pair_cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(total)
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, table in enumerate(tables):
            g, h = (np.bincount(bins[i], s, len(table)) for s in slopes())
            step = RATE * _tree(g, h)
            table += step
            total += step[bins[i]]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(pair_cuts[a]) + 1, len(pair_cuts[b]) + 1)
        at = coarse[a] * shape[1] + coarse[b]
        g, h = (np.bincount(at, s, shape[0] * shape[1]).reshape(shape) for s in slopes())
        return g, h

    gains = sorted(
        ((_pair_tree(*grid(a, b))[0], a, b) for a, b in combinations(range(width), 2)), reverse=True
    )
    pairs = [
        (a, b, np.zeros((len(pair_cuts[a]) + 1, len(pair_cuts[b]) + 1)))
        for gain, a, b in gains[:PAIRS]
        if gain > 0
    ]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in pairs:
            step = RATE * _pair_tree(*grid(a, b))[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return Model(start, cuts, pair_cuts, tables, pairs)


def fold(doc_id: str = "doc_id", folds: int = 5):
    return F.crc32(F.col(doc_id).cast("string")) % folds


def _labelled(counted: DataFrame, labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the sample. Of contradictory labels the least counts."""
    known = (
        labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("int"))
        .where(F.col("quality").isin(0, 1) & (fold() != 0))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = (
        counted.join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("features").alias("features"))
        .orderBy("doc_id")
        .collect()
    )
    x = np.array([r["features"] for r in rows]).reshape(len(rows), len(features(b"")))
    return x, np.array([r["quality"] for r in rows], float)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    most_labelled: int = MOST_LABELLED,
    predict_from: float = PREDICT_FROM,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``.

    ``labels`` has ``doc_id`` and ``quality`` 0 or 1; other values are no label.
    Rows whose ``crc32(doc_id)`` mod 5 is 0 are held out of the fit. ``score``
    is the probability of label 1, ``predicted`` is 1 from ``predict_from`` on.
    Null texts count as empty and are scored too; texts count whole. Rows
    without an id are scored and not held out. Repeated rows each get a row, and
    are fitted to once, by
    the least of their features. Without labels all scores are 0.5.
    """
    counted = durable(
        per_text(documents(docs), lambda t: (features(t),), "features array<double>"), "features"
    )
    x, y = _labelled(counted, labels, most_labelled)
    model, width = fit(x, y), x.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                score = model.score(flat.reshape(batch.num_rows, width))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(score)], names=["doc_id", "score"]
                )

    scored = counted.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= predict_from).cast("int").alias("predicted"),
    )
