"""Quality rules as weak supervision: rules vote, their votes are weighed by accuracy.

A pass over the texts counts what the rules look at. Each rule votes for a text
(clean), against it, or abstains where it cannot tell. The distinct vote
patterns, counted over all documents, are all the estimation of the rules'
accuracies needs. A document stays if it passes the base rules and the posterior
probability of being clean is high enough.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import documents, per_text
from shoptrail.llm.voting import ABSTAIN, AGAINST, FOR, Votes, estimate
from shoptrail.sources.durable import durable

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated windows
WINDOW = 3
KEEP_FROM = 0.5

_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(c for c in range(256) if c not in _SYMBOLS)
_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_LETTERS = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122 or c >= 128))
_CONTINUED = bytes(range(0x80, 0xC0))
_ENDS = re.compile(rb"[.!?]+(?=[\x20\x09-\x0D]|$)")

# Words that end in what ends no word of prose.
_ODD_ENDS = re.compile(rb"[^\x20\x09-\x0Da-zA-Z0-9.,;:!?)\"'\x80-\xff](?=[\x20\x09-\x0D]|$)")

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _code_points(text: bytes) -> int:
    return len(text.translate(None, _CONTINUED))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of words that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    gram = ids[:n]
    for i in range(1, window):
        if i > 1 and len(number) ** (i + 1) >= 1 << 62:  # numbered anew, to fit
            gram = np.unique(gram, return_inverse=True)[1]
        gram = gram * len(number) + ids[i : i + n]
    order = np.argsort(gram, kind="stable")
    ordered = gram[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    if not twice.any():
        return 0
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : i + n] |= twice
    return int(covered.sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """The values of ``BASE``."""
    chars = sum(map(len, words)) if text.isascii() else sum(map(_code_points, words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        chars,
        len(text.translate(None, _NOT_SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def _band(value: float, good: float, bad: float) -> int:
    """For up to ``good``, against from ``bad`` on; ``good`` may be the greater."""
    if good <= bad:
        return FOR if value <= good else AGAINST if value >= bad else ABSTAIN
    return FOR if value >= good else AGAINST if value <= bad else ABSTAIN


# The rules: what they look at, and where they vote for and against.
RULES = (
    ("word_length_low", 3.0, 2.2),
    ("word_length_high", 9.0, 14.0),
    ("symbols_per_word", 0.02, 0.15),
    ("odd_ends_share", 0.03, 0.2),
    ("letter_share", 0.9, 0.8),
    ("dup_line_share", 0.1, 0.35),
    ("repeated_share", 0.1, 0.4),
    ("distinct_share", 0.5, 0.25),
    ("upper_share", 0.15, 0.6),
    ("shouted_share", 0.02, 0.2),
    ("words_per_sentence", 40.0, 120.0),
)


def rule_values(text: bytes, words: list[bytes], base: tuple[int, ...]) -> tuple[float, ...]:
    """What each of ``RULES`` looks at."""
    n, chars, symbols, dup_lines, repeated = base
    letters = len(text.translate(None, _NOT_LETTERS))
    some, packed = max(1, n), max(1, sum(map(len, words)))
    return (
        chars / some,
        chars / some,
        symbols / some,
        len(_ODD_ENDS.findall(text)) / some,
        letters / packed,
        dup_lines / (text.count(b"\n") + 1),
        repeated / some,
        len(set(words)) / some**0.8,
        len(text.translate(None, _NOT_UPPER)) / max(1, letters),
        text.count(b"!") / some,
        n / max(1, len(_ENDS.findall(text))),
    )


def votes(text: bytes, words: list[bytes], base: tuple[int, ...]) -> list[int]:
    values = rule_values(text, words, base)
    return [_band(v, good, bad) for v, (_, good, bad) in zip(values, RULES, strict=True)]


def pattern_number(cast: list[int]) -> int:
    number = 0
    for vote in cast:
        number = number * 3 + vote + 1
    return number


def pattern_votes(number: int, n: int = len(RULES)) -> list[int]:
    return [number // 3**i % 3 - 1 for i in range(n - 1, -1, -1)]


def _counted(text: bytes) -> tuple[int, ...]:
    words = text.split()
    base = base_counts(text, words)
    return (*base, pattern_number(votes(text, words, base)))


def rule_votes(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts of ``BASE`` and ``pattern``: the votes as one number."""
    schema = ", ".join(f"{c} long" for c in (*BASE, "pattern"))
    return per_text(documents(docs), _counted, schema)


def weigh(voted: DataFrame) -> tuple[list[int], Votes]:
    """Patterns found, most common first, and the estimated accuracies.

    The driver gets one row per pattern, at most 3 ** rules of them.
    """
    rows = voted.groupBy("pattern").count().collect()
    rows.sort(key=lambda r: (-r["count"], r["pattern"]))
    patterns = [r["pattern"] for r in rows]
    cast = np.array([pattern_votes(p) for p in patterns], int).reshape(-1, len(RULES))
    return patterns, estimate(cast, np.array([r["count"] for r in rows]), share=0.8)


def judge(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row: ``doc_id``, ``BASE`` counts, ``base_failed``, ``quality``, ``kept``.

    ``quality`` is the posterior probability that a text is clean. Null texts
    count as empty, which fails the base rules; very long texts are counted
    whole. Repeated rows vote as often as they occur. An empty table gives an
    empty result. Other columns of ``docs`` are ignored.
    """
    voted = durable(rule_votes(docs), "votes")
    patterns, found = weigh(voted)
    cast = np.array([pattern_votes(p) for p in patterns], int).reshape(-1, len(RULES))
    quality = found.posterior(cast).tolist()
    # At most 3 ** rules rows.
    table = docs.sparkSession.createDataFrame(
        list(zip(patterns, quality, strict=True)), "pattern long, quality double"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return (
        voted.join(F.broadcast(table), "pattern")
        .withColumn("base_failed", failed)
        .select(
            "doc_id",
            *BASE,
            "base_failed",
            "quality",
            (~F.col("base_failed") & (F.col("quality") >= keep_from)).alias("kept"),
        )
    )
