"""Quality rules, their weights, and the additive model."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shoptrail.llm.quality_gam import features, fit, quality_scores
from shoptrail.llm.quality_rules import base_counts, judge, pattern_number, pattern_votes, repeated_words
from shoptrail.llm.voting import AGAINST, FOR, estimate


def plain_repeats(words):
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    return len({i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)})


@pytest.mark.parametrize("seed", range(30))
def test_repeated_words(seed):
    rng = random.Random(seed)
    words = [str(rng.randrange(1 + seed)).encode() for _ in range(rng.randrange(60))]
    assert repeated_words(words) == plain_repeats(words)


def test_base_counts():
    text = "été #a\n\n \nété #a\nb|c <d>\nété  #a\n"
    raw = text.encode()
    chars = sum(len(w) for w in text.split())
    assert base_counts(raw, raw.split()) == (8, chars, 6, 1, plain_repeats(text.split()))
    assert base_counts(b"", []) == (0, 0, 0, 0, 0)


def test_pattern_numbers():
    rng = random.Random(1)
    for _ in range(100):
        votes = [rng.choice([-1, 0, 1]) for _ in range(11)]
        assert pattern_votes(pattern_number(votes), 11) == votes


def test_accuracies_are_recovered():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    right, votes_at_all = [0.95, 0.9, 0.8, 0.7], [1.0, 0.8, 0.9, 0.5]
    votes = np.zeros((len(truth), 4), int)
    for k in range(4):
        correct = rng.random(len(truth)) < right[k]
        vote = np.where(correct == truth, FOR, AGAINST)
        votes[:, k] = np.where(rng.random(len(truth)) < votes_at_all[k], vote, 0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = estimate(patterns, counts, 0.8)
    assert abs(found.share - 0.8) < 0.03
    assert np.abs(found.accuracy() - right).max() < 0.03
    none = estimate(np.empty((0, 4), int), np.empty(0), 0.8)
    assert none.share == pytest.approx(0.8)


def prose(rng, n=120):
    words = [rng.choice("the of land water quiet river stone morning people walked along slowly".split()) +
             rng.choice(["", "", str(rng.randrange(10)) * 0, "s"]) for _ in range(n)]
    made = [w + str("abcdefgh"[rng.randrange(8)] * rng.randrange(3)) for w in words]
    return " ".join(w + ("." if i % 12 == 11 else "") for i, w in enumerate(made))


def junk(rng, n=120):
    kind = rng.randrange(3)
    words = prose(rng, n).split()
    if kind == 0:
        return " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in words)
    if kind == 1:
        return " | ".join(words)
    return "!! ".join(w.upper() for w in words)


def corpus(seed, n=600):
    rng = random.Random(seed)
    return [(i, junk(rng) if i % 6 == 0 else prose(rng)) for i in range(n)]


def test_rules_keep_prose_and_not_junk(docs_of):
    rows = corpus(1) + [(9000, "too short"), (9001, None), (9002, "same three words " * 100)]
    found = {r["doc_id"]: r for r in judge(docs_of(rows)).collect()}
    assert all(found[i]["kept"] == (i % 6 != 0) for i, _ in corpus(1))
    for i in (9000, 9001, 9002):
        assert found[i]["base_failed"] and not found[i]["kept"]


def test_classifier_on_held_out_rows(docs_of, spark):
    rows = corpus(2, 900)
    labels = spark.createDataFrame(
        [(i, int(i % 6 != 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int"
    )
    found = quality_scores(docs_of(rows), labels).collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert np.mean([r["predicted"] == (r["doc_id"] % 6 != 0) for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_pairs_learn_what_no_single_feature_shows():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x, y)
    test = rng.random((1000, 3))
    wanted = (test[:, 0] > 0.5) ^ (test[:, 1] > 0.5)
    assert ((model.score(test) > 0.5) == wanted).mean() > 0.93
    assert (model.pairs[0][0], model.pairs[0][1]) == (0, 1)


def test_features_of_nothing():
    assert len(features(b"")) == len(features(b"some words")) and all(map(np.isfinite, features(b"")))
