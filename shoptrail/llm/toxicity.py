"""Toxicity scores by a support vector machine on a subsequence string kernel.

Two words are alike if they share subsequences of three letters, with gaps: an occurrence
weighs less the more letters it skips, so an insult with characters put in between, left
out or changed still shares most of its subsequences. The kernel of two words is the cosine
of their subsequences to a power; that of a sentence and a word adds up its words.

Landmarks stand for all words (Nyström): of the words whose share of toxic texts is most
telling, those that the ones chosen before explain least. A linear machine is trained on
sentences, which have the label of their text, in the space the landmarks span. It folds
into one weight per landmark, so a sentence's value is a sum of values of its words, and a
word's value is found once for all places it stands in. A logistic model of few figures,
such as the highest value of a sentence, makes them a probability for the text.

Words and sentences of all texts are valued on the executors. The driver fits the model to
a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import documents, send
from shoptrail.sources.durable import durable

# The most labelled rows the model is fitted to, those with the least hashes, and about the
# most sentences of each label.
MOST_LABELLED, MOST_SENTENCES = 20_000, 15_000
PREDICT_FROM = 0.5
# Landmarks, and the words they are chosen from by what speaks for toxic and for clean
# texts, and by a hash.
LANDMARKS, CANDIDATES = 256, (1024, 256, 256)
GAP = 0.8  # weight of a skipped letter
SPAN = 6  # letters a subsequence of three may reach over
POWER = 5
LONGEST, STRIDE = 24, 12  # a longer word is seen in overlapping stretches
SENTENCE = 40  # words; a longer sentence is cut
SPELT = 3  # as many single letters in a row are a word spelt out
COST, RIDGE = 1.0, 1e-6
KNOWN = 1 << 18  # words whose values a task keeps

_SIGNS = r"[\p{P}\p{S}]+"
_LINE_END = " . "


@cache
def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the subsequences of three of ``n`` letters, and their weights."""
    found = [
        (i, j, k)
        for i in range(n)
        for j in range(i + 1, n)
        for k in range(j + 1, min(n, i + SPAN))
    ]
    at = np.array(found, np.intp).reshape(len(found), 3)
    return at[:, 0], at[:, 1], at[:, 2], GAP ** (at[:, 2] - at[:, 0] - 2.0)


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(places in words, keys, weights)`` of words of equal length.

    A word has marks at both ends. Three code points of 21 bits make a key. Weights of
    equal subsequences of a word are added up, in the first of them, and a word's squares
    add up to 1.
    """
    sizes = np.fromiter(map(len, words), np.intp, len(words))
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        flat = "".join([words[p] for p in places]).encode("utf-32-le", "replace")
        letters = np.ones((len(places), size + 2), np.int64)  # 1 marks an end
        letters[:, 1:-1] = np.frombuffer(flat, np.uint32).reshape(len(places), size)
        i, j, k, weights = _triples(int(size) + 2)
        keys = letters[:, i] << 42 | letters[:, j] << 21 | letters[:, k]
        order = np.argsort(keys, axis=1)
        keys = np.take_along_axis(keys, order, 1)
        weights = weights[order]
        new = np.ones(keys.shape, bool)
        new[:, 1:] = keys[:, 1:] != keys[:, :-1]
        flat_new = np.flatnonzero(new.ravel())
        summed = np.zeros(keys.size)
        summed[flat_new] = np.add.reduceat(weights.ravel(), flat_new) if keys.size else 0
        weights = summed.reshape(keys.shape)
        norms = np.sqrt((weights**2).sum(axis=1, keepdims=True))
        yield places, keys, weights / np.maximum(norms, 1e-12)


class Landmarks:
    """Kernels of words with a fixed list of words.

    By subsequence, the landmarks that have it follow each other: few do, so a word meets
    few entries, whatever the number of landmarks.
    """

    def __init__(self, words: list[str]) -> None:
        self.words = words
        keys, weights, owners = [], [], []
        for places, k, w in subsequences(words):
            used = w > 0
            keys.append(k[used])
            weights.append(w[used])
            owners.append(np.repeat(places, used.sum(axis=1)))
        flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.keys, starts = np.unique(flat[order], return_index=True)
        self.bounds = np.append(starts, len(flat)).astype(np.intp)
        self.owners = np.concatenate(owners)[order] if keys else np.empty(0, np.intp)
        self.weights = np.concatenate(weights)[order] if keys else np.empty(0)
        self.known = np.zeros(1 << 20, bool)  # most other keys are told by their hash
        self.known[self._slots(self.keys)] = True

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(44)).astype(np.intp)

    def kernel(self, words: list[str]) -> np.ndarray:
        """A row per word, a column per landmark. Words have ``LONGEST`` letters at most."""
        most = len(self.words)
        out = np.zeros((len(words), most))
        if not len(self.keys):
            return out
        for places, keys, weights in subsequences(words):
            hit = self.known[self._slots(keys)] & (weights > 0)
            row = np.nonzero(hit)[0]
            mine, share = keys[hit], weights[hit]
            at = np.minimum(np.searchsorted(self.keys, mine), len(self.keys) - 1)
            same = self.keys[at] == mine
            row, at, share = row[same], at[same], share[same]
            n = self.bounds[at + 1] - self.bounds[at]
            entry = np.arange(n.sum()) + np.repeat(self.bounds[at] - (np.cumsum(n) - n), n)
            cell = np.repeat(row, n) * most + self.owners[entry]
            sums = np.bincount(cell, np.repeat(share, n) * self.weights[entry], len(places) * most)
            out[places] = sums.reshape(len(places), most)
        powers = out.copy()
        for _ in range(POWER - 1):  # many times faster than a general power
            powers *= out
        return powers


# -- Texts as words and sentences ---------------------------------------------------------


@dataclass
class Words:
    """The words of a batch of texts: distinct ones, and where they stand."""

    distinct: list[str]
    at: np.ndarray  # of each word, its place in ``distinct``
    starts: np.ndarray  # first words of sentences
    texts: np.ndarray  # of each sentence, its text


def words_of(texts: pa.Array) -> Words:
    """Words of lower-cased texts (null: empty) by sentence, without the signs in them.

    A sentence ends with ``.!?`` and with a line, and after ``SENTENCE`` words. Single
    letters in a row are one word, at the first of them; the others are empty there.
    """
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), ""))
    lines = pc.replace_substring(lowered, "\n", _LINE_END)
    lists = pc.utf8_split_whitespace(lines)
    raw = lists.flatten().dictionary_encode()
    # Texts that begin with white space have an empty first word.
    at = raw.indices.to_numpy(zero_copy_only=False)
    bare = pc.replace_substring_regex(raw.dictionary, _SIGNS, "").dictionary_encode()
    distinct = bare.dictionary.to_pylist()
    ends = pc.match_substring_regex(raw.dictionary, r"[.!?]['\")\]]*$")
    ends = ends.to_numpy(zero_copy_only=False).astype(bool)
    of_raw = bare.indices.to_numpy(zero_copy_only=False)
    mapped = of_raw[at] if len(at) else np.empty(0, np.intp)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.intp)
    owner = np.repeat(np.arange(len(counts)), counts)

    first = np.ones(len(at), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (ends[at[:-1]] if len(at) else False)
    index = np.arange(len(at))
    since = index - np.maximum.accumulate(np.where(first, index, 0)) if len(at) else index
    starts = np.flatnonzero(since % SENTENCE == 0)

    single = np.array([len(w) == 1 for w in distinct], bool)
    lone = single[mapped] if len(at) else np.empty(0, bool)
    mapped = mapped.astype(np.intp)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], lone.astype(np.int8), [0]))))
    for low, high in zip(edges[::2], edges[1::2]):
        if high - low >= SPELT:
            bounds = [low, *(low + 1 + np.flatnonzero(first[low + 1 : high])), high]
            for a, b in zip(bounds, bounds[1:]):
                if b - a >= SPELT:
                    distinct.append("".join([distinct[m] for m in mapped[a:b]]))
                    mapped[a:b] = -1
                    mapped[a] = len(distinct) - 1
    distinct.append("")
    mapped[mapped < 0] = len(distinct) - 1
    return Words(distinct, mapped, starts, owner[starts])


def stretches(word: str) -> list[str]:
    """A word, or the overlapping stretches of a long one."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST + STRIDE, STRIDE)]


def _best(values: np.ndarray, sizes: list[int]) -> np.ndarray:
    """The largest value of each word's stretches."""
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.intp)
    return np.maximum.reduceat(values, starts, axis=0) if len(sizes) else values


def word_kernels(landmarks: Landmarks, words: list[str]) -> np.ndarray:
    parts = [stretches(w) for w in words]
    return _best(landmarks.kernel([p for s in parts for p in s]), [len(s) for s in parts])


def _per_sentence(values: np.ndarray, words: Words) -> np.ndarray:
    """Sums of the words' values by sentence, over the root of its number of words."""
    if not len(words.starts):
        return np.zeros((0, *values.shape[1:]))
    sums = np.add.reduceat(values[words.at], words.starts, axis=0)
    n = np.diff(words.starts, append=len(words.at))
    return sums / np.sqrt(n).reshape(-1, *[1] * (values.ndim - 1))


FIGURES = 6


def text_figures(values: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """What tells of a text: figures of its sentences' values. Zeros for a text without any."""
    out = np.zeros((n, FIGURES))
    if len(values):
        starts = np.flatnonzero(np.diff(owners, prepend=-1))
        mine, sizes = owners[starts], np.diff(starts, append=len(values))
        positive = np.maximum(values, 0)
        out[mine, 0] = np.maximum.reduceat(values, starts).clip(-3, 3)
        out[mine, 1] = np.add.reduceat(values, starts) / sizes
        out[mine, 2] = np.add.reduceat(positive, starts) / sizes
        out[mine, 3] = np.add.reduceat((values > 0).astype(float), starts) / sizes
        out[mine, 4] = np.log1p(np.add.reduceat(positive, starts))
        out[mine, 5] = np.log1p(sizes)
    return out


# -- The model ----------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def choose(words: list[str], weights: np.ndarray, most: int) -> list[str]:
    """Landmarks: in turn the word with the most weighed part that those before don't explain.

    This is a pivoted Cholesky factorisation of the words' kernel matrix.
    """
    k = Landmarks(words).kernel(words)
    left = np.diag(k).copy()
    factor = np.zeros((len(words), min(most, len(words))))
    chosen: list[int] = []
    for c in range(factor.shape[1]):
        gain = np.where(left > 1e-3, left * weights, 0.0)
        gain[chosen] = 0.0
        p = int(gain.argmax())
        if gain[p] <= 0:
            break
        column = (k[:, p] - factor[:, :c] @ factor[p, :c]) / np.sqrt(left[p])
        factor[:, c] = column
        left = np.maximum(left - column**2, 0)
        chosen.append(p)
    return [words[p] for p in chosen]


def train_svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear machine with squared hinge loss, by Newton steps.

    Rows of ``x`` are sentences, ``y`` is -1 or 1; both labels weigh the same in all.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    active = np.ones(len(y), bool)
    for _ in range(30):
        weighed = x[active] * share[active, None]
        w = np.linalg.solve(ridge + 2 * COST * x[active].T @ weighed, 2 * COST * weighed.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def train_logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic model, by Newton steps; a ridge bounds the weights."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """Landmarks with a weight each, and the logistic model of a text's figures."""

    landmarks: Landmarks
    weights: np.ndarray
    offset: float
    slopes: np.ndarray
    level: float
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def word_values(self, words: list[str]) -> np.ndarray:
        """What each word adds to a sentence. A task keeps the values of many words."""
        if len(self.known) > KNOWN:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        for i in range(0, len(new), 2048):
            part = new[i : i + 2048]
            parts = [stretches(w) for w in part]
            flat = self.landmarks.kernel([p for s in parts for p in s]) @ self.weights
            self.known.update(zip(part, _best(flat, [len(s) for s in parts]).tolist()))
        return np.array([self.known[w] for w in words])

    def figures(self, texts: pa.Array) -> np.ndarray:
        words = words_of(texts)
        values = _per_sentence(self.word_values(words.distinct), words) + self.offset
        return text_figures(values, words.texts, len(texts))

    def score(self, texts: pa.Array) -> np.ndarray:
        return _sigmoid(self.figures(texts) @ self.slopes + self.level)


def flat_model(share: float) -> Model:
    """Without two labels to tell apart, every text has the same score."""
    level = float(np.log(share / (1 - share)))
    return Model(Landmarks([]), np.zeros(0, np.float32), 0.0, np.zeros(FIGURES), level)


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``(doc_id, text, toxic)`` of the sample. Of contradictory labels the least counts."""
    known = (
        labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"))
        .where(F.col("toxic").isin(0, 1) & (fold() != 0))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"))
    )
    # At most ``most`` rows.
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    joined = documents(docs).join(F.broadcast(sample), "doc_id")
    return durable(joined.where(F.col("text").isNotNull()).distinct(), "labelled")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By word the texts of each label that have it; in the row without a word, sentences."""
    for batch in batches:
        if not batch.num_rows:
            continue
        words = words_of(batch.column("text"))
        toxic = batch.column("toxic").to_numpy()
        sizes = np.diff(words.starts, append=len(words.at))
        owner = np.repeat(words.texts, sizes)
        met = np.unique(owner * len(words.distinct) + words.at)
        mine = toxic[met // len(words.distinct)]
        n = [np.bincount(met[mine == t] % len(words.distinct), minlength=len(words.distinct)) for t in (0, 1)]
        usable = [i for i, w in enumerate(words.distinct) if 2 <= len(w) <= LONGEST]
        sentences = np.bincount(toxic[words.texts], minlength=2)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([words.distinct[i] for i in usable] + [None], pa.string()),
                pa.array(np.append(n[0][usable], sentences[0]), pa.int64()),
                pa.array(np.append(n[1][usable], sentences[1]), pa.int64()),
            ],
            names=["word", "clean", "toxic"],
        )


def _candidates(counts: DataFrame, clean: int, toxic: int, most: tuple[int, ...]) -> dict[str, float]:
    """Words to choose landmarks from, with how much they tell."""
    all_share = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    spread = F.sqrt(all_share * (1 - all_share) * (1 / toxic + 1 / clean))
    z = (F.col("toxic") / toxic - F.col("clean") / clean) / F.greatest(spread, F.lit(1e-9))
    told = counts.where("word is not null").select("word", z.alias("z"))
    orders = [(F.desc("z"), "word"), (F.asc("z"), "word"), (F.xxhash64("word"), "word")]
    found: dict[str, float] = {}
    for order, n in zip(orders, most, strict=True):
        for row in told.orderBy(*order).limit(n).collect():
            found[row["word"]] = max(1.0, row["z"])
    return found


def _sentence_kernels(sample: DataFrame, landmarks: Landmarks, shares: list[float]) -> tuple:
    """Kernel rows and labels of about a share of the sentences of each label."""
    held = send(sample.sparkSession, landmarks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = words_of(batch.column("text"))
            ids = batch.column("doc_id").to_numpy().astype(np.uint64)[words.texts]
            labels = batch.column("toxic").to_numpy()[words.texts]
            number = np.arange(len(ids)) - np.searchsorted(words.texts, words.texts)
            with np.errstate(over="ignore"):
                mixed = (ids * np.uint64(0x9E3779B97F4A7C15)) ^ (
                    number.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                )
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            drawn = (mixed >> np.uint64(11)) / 2.0**53 < np.array(shares)[labels]
            sizes = np.diff(words.starts, append=len(words.at))
            keep = np.flatnonzero(drawn)
            for low in range(0, len(keep), 2000):
                some = keep[low : low + 2000]
                at = np.concatenate(
                    [words.at[words.starts[s] : words.starts[s] + sizes[s]] for s in some]
                )
                used, mapped = np.unique(at, return_inverse=True)
                part = Words(
                    [words.distinct[u] for u in used],
                    mapped,
                    np.concatenate(([0], np.cumsum(sizes[some])[:-1])).astype(np.intp),
                    some,
                )
                rows = _per_sentence(word_kernels(held(), part.distinct), part)
                packed = [r.tobytes() for r in rows.astype(np.float32)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[some].astype(np.int64)),
                        pa.array(number[some]),
                        pa.array(labels[some]),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["doc_id", "number", "toxic", "kernel"],
                )

    kernels = sample.mapInArrow(run, "doc_id long, number long, toxic int, kernel binary")
    rows = kernels.orderBy("doc_id", "number", "kernel").collect()
    width = len(landmarks.words)
    x = np.array([np.frombuffer(r["kernel"], np.float32) for r in rows], float)
    return x.reshape(len(rows), width), np.array([2.0 * r["toxic"] - 1 for r in rows])


def _text_rows(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    held = send(sample.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = held().figures(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("toxic"), pa.array(list(found))],
                    names=["doc_id", "toxic", "figures"],
                )

    rows = sample.mapInArrow(run, "doc_id long, toxic int, figures array<double>")
    found = rows.orderBy("doc_id", "figures").collect()
    x = np.array([r["figures"] for r in found]).reshape(len(found), FIGURES)
    return x, np.array([r["toxic"] for r in found], float)


def fit(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> Model:
    """The model for ``labels.toxic`` of at most ``most_labelled`` rows out of the fold held out."""
    sample = labelled_sample(docs, labels, most_labelled)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return flat_model((toxic + 1) / (clean + toxic + 2))
    counts = durable(
        sample.mapInArrow(_counts, "word string, clean long, toxic long")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "word-labels",
    )
    told = _candidates(counts, clean, toxic, CANDIDATES)
    words = sorted(told)
    landmarks = Landmarks(choose(words, np.array([told[w] for w in words]), LANDMARKS))
    sentences = counts.where("word is null").first()
    shares = [min(1.0, MOST_SENTENCES / max(1, sentences[c])) for c in ("clean", "toxic")]
    x, y = _sentence_kernels(sample, landmarks, shares)
    if len({*y}) < 2:
        return flat_model((toxic + 1) / (clean + toxic + 2))
    model = _machine(landmarks, x, y)
    model.slopes, model.level = train_logistic(*_text_rows(sample, model))
    return model


def _machine(landmarks: Landmarks, x: np.ndarray, y: np.ndarray) -> Model:
    """The machine trained in the space the landmarks span, with a weight per landmark.

    The way there is the landmarks' kernel matrix to the power -1/2.
    """
    values, vectors = np.linalg.eigh(landmarks.kernel(landmarks.words))
    root = vectors / np.sqrt(np.maximum(values, RIDGE)) @ vectors.T
    w, offset = train_svm(x @ root, y)
    return Model(landmarks, (root @ w).astype(np.float32), offset, np.zeros(FIGURES), 0.0)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    most_labelled: int = MOST_LABELLED,
    predict_from: float = PREDICT_FROM,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``.

    ``labels`` has ``doc_id`` and ``toxic`` 0 or 1; other values are no label, and of
    contradictory labels of an id the least counts. Rows whose ``crc32(doc_id)`` mod 5 is
    0 are held out of the fit. ``score`` is the probability of label 1, ``predicted`` is 1
    from ``predict_from`` on.

    Null texts count as empty and are scored too, like a text without a toxic sentence;
    texts and words count whole, whatever their length. Rows without an id are scored and
    not held out. Repeated rows each get a row and are fitted to once. Without labels, or
    with one label only, all texts have one score. An empty table gives no rows. Other
    columns are not read.
    """
    model = send(docs.sparkSession, fit(docs, labels, most_labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = pa.array(model().score(batch.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), score], names=["doc_id", "score"]
                )

    scored = documents(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= predict_from).cast("int").alias("predicted"),
    )
