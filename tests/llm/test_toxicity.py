import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from shoptrail.llm import toxicity
from shoptrail.llm.toxicity import Landmarks, choose, toxicity_scores, words_of

SCHEMA = "doc_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def plain_kernel(x, y):
    """The cosine of gapped subsequences of three, to the power, from the definition."""

    def weights(word):
        word, out = f"\1{word}\1", {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + toxicity.SPAN)):
                    key = word[i] + word[j] + word[k]
                    out[key] = out.get(key, 0) + toxicity.GAP ** (k - i - 2)
        return out

    a, b = weights(x), weights(y)
    dot = sum(v * b.get(u, 0) for u, v in a.items())
    size = np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    return (dot / size) ** toxicity.POWER


def test_kernel_is_its_definition():
    words = ["idiot", "id1ot", "banana", "nana", "aaaa", "été", "x", "ab", "Ünïcode", "idxiot"]
    found = Landmarks(words).kernel(words)
    expected = [[plain_kernel(a, b) for b in words] for a in words]
    assert np.allclose(found, expected, atol=1e-5)


def test_gaps_and_inserted_letters_stay_near():
    near = Landmarks(["worthless"]).kernel(["worthless", "worxthless", "worthles", "worth", "table"])
    values = near[:, 0]
    assert values[0] == pytest.approx(1)
    assert min(values[1:3]) > 10 * max(values[3:])


def test_words_and_sentences():
    texts = pa.array(["Ab c. De\nf g", None, "", "i d i o t, a b. w.o-r*d", "x " * 100])
    words = words_of(texts)
    spelt = [words.distinct[i] for i in words.at[:6]]
    assert spelt == ["ab", "c", "de", "", "f", "g"]
    assert "idiotab" in words.distinct and "word" in words.distinct
    assert words.texts.tolist() == [0, 0, 0, 1, 2, 3, 3, 4, 4, 4]
    ends = np.diff(words.starts, append=len(words.at))
    assert ends.max() <= toxicity.SENTENCE


def test_landmarks_are_told_words_that_differ():
    words = ["idiot", "idiots", "the", "thing", "stupid"]
    weights = np.array([9.0, 8.5, 1.0, 1.0, 8.0])
    assert choose(words, weights, 2) == ["idiot", "stupid"]


def corpus(n=600):
    plain = "the small house by the river has a garden with many old trees and one door".split()
    bad = ["dumbhead", "ratface", "wormbrain"]
    rows, labels = [], []
    for i in range(n):
        words = random.Random(i).choices(plain, k=30)
        if toxic := i % 4 == 0:
            words[i % 29] = bad[i % 3]
            words[(i + 9) % 29] = bad[(i + 1) % 3]
        rows.append((i, " ".join(words[:15]) + ". " + " ".join(words[15:]) + "."))
        labels.append((i, None, int(toxic)))
    return rows, labels


def test_held_out_rows_and_disguised_words(spark):
    rows, labels = corpus()
    base = "a garden with many old trees"
    disguised = ["dumbxhead ratfface", "d u m b h e a d", "w.o.r.m.b.r.a.i.n rat-face", "wormbrainn d.umb-head"]
    more = [(10_000 + i, f"{base} {d} and one door.") for i, d in enumerate(disguised)]
    clean = [(20_000, f"{base} and one door."), (20_001, None), (20_002, ""), (None, base)]
    docs = spark.createDataFrame(rows + more + clean, SCHEMA).repartition(5)
    found = toxicity_scores(docs, spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: t for i, _, t in labels}
    truth |= {i: 1 for i, _ in more} | {i: 0 for i, _ in clean}
    assert len(found) == len(truth)
    for r in found:
        assert r["predicted"] == truth[r["doc_id"]] == int(r["score"] >= 0.5), r
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == held and 0 <= r["score"] <= 1


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, SCHEMA)
    other = [
        (i, None, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, _, t in labels
    ]
    scores = [
        sorted(toxicity_scores(docs, spark.createDataFrame(some, LABELS)).collect())
        for some in (labels, other, labels)
    ]
    assert scores[0] == scores[1] == scores[2]


def test_one_label_or_none(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], SCHEMA)
    for labels, score in (([], 0.5), ([(1, 1, 0), (2, 0, 7)], 1 / 3)):
        found = toxicity_scores(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert [round(r["score"], 9) for r in found] == [round(score, 9)] * 2


def test_odd_rows(spark, odd, some_labels):
    found = toxicity_scores(odd, some_labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert found.count() == odd.count()
    assert toxicity_scores(odd.limit(0), some_labels).collect() == []
