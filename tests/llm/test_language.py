import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from shoptrail.llm import language as L

SYLLABLES = {"aa": "ba be bi bo bu ta te ti", "bb": "sch ung lich kra wol zen pfe", "cc": "ção nh lh ães ris vou"}


def corpus(seed, n=240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        parts = SYLLABLES[lang].split()
        words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(3, 60))]
        rows.append((i, " ".join(words).capitalize() + ".", lang))
    return rows


def letters(text):
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    return " " + " ".join(low.split()) + " "


def plain_model(texts, order=4, d=0.75):
    """Interpolated Kneser-Ney from dictionaries of n-grams."""
    grams = Counter()
    for t in texts:
        padded = " " * (order - 1) + letters(t)
        for i in range(order, len(padded)):
            grams[padded[i - order + 1 : i + 1]] += 1
    tables = {order: grams}
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])
    totals, types = defaultdict(int), defaultdict(int)
    for n, table in tables.items():
        for g, c in table.items():
            totals[n, g[:-1]] += c
            types[n, g[:-1]] += 1

    def p(gram):
        n = len(gram)
        rest = p(gram[1:]) if n > 1 else 1 / (types[1, ""] + 1)
        if not totals[n, gram[:-1]]:
            return rest
        total = totals[n, gram[:-1]]
        return (max(tables[n][gram] - d, 0) + d * types[n, gram[:-1]] * rest) / total

    return p


def plain_entropy(p, text, order=4):
    padded = " " * (order - 1) + letters(text)
    logs = [math.log(p(padded[i - order + 1 : i + 1])) for i in range(order, len(padded))]
    return -sum(logs) / len(logs)


def test_probabilities_equal_plain_kneser_ney(docs_of):
    rows = corpus(1, 60)
    models = L.train(docs_of(rows))
    clean = L._Letters()
    tests = [t for _, t, _ in corpus(2, 20)] + ["qqq", "Ünknown wörds 12 here", "a"]
    found, length = models.cross_entropies([clean(t) for t in tests], len(tests))
    assert length.tolist() == [len(letters(t)) - 1 for t in tests]
    for k, lang in enumerate(models.languages):
        p = plain_model([t for _, t, own in rows if own == lang])
        expected = [plain_entropy(p, t) for t in tests]
        assert found[:, k] == pytest.approx(expected, rel=1e-4)


def test_held_out_accuracy_and_rejection(docs_of):
    rows = corpus(3, 400)
    rng = random.Random(1)
    noise = [(9000 + i, "".join(rng.choices("qxjkwzvy ", k=300)), None) for i in range(5)]
    empty = [(9100, None, "aa"), (9101, "", "bb"), (9102, "12 +- 3", "aa")]
    found = {r["doc_id"]: r for r in L.identify(docs_of(rows + noise + empty)).collect()}
    held = [(d, lang) for d, _, lang in rows if found[d]["held_out"]]
    assert len(held) > 80
    assert np.mean([found[d]["lang_pred"] == lang for d, lang in held]) > 0.99
    assert all(found[d]["accepted"] for d, _, _ in rows)
    assert not any(found[d]["accepted"] for d, _, _ in noise)
    for d, _, _ in empty:
        assert (found[d]["lang_pred"], found[d]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_the_same_for_any_partitioning(docs_of):
    rows = corpus(4, 90)
    one, two = (
        {r["doc_id"]: (r["lang_pred"], round(r["cross_entropy"], 9)) for r in L.identify(docs_of(rows, n)).collect()}
        for n in (1, 9)
    )
    assert one == two


def test_kept_documents_are_the_accepted_ones(docs_of):
    rows = corpus(5, 60) + [(900, None, None), (901, "...", None)]
    kept = L.accepted_documents(docs_of(rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(60))


def test_many_ngrams_keep_their_own_probabilities(docs_of):
    """A script of 3000 letters, with most of its 4-grams seen once."""
    rng = random.Random(6)
    text = lambda k: "".join(" " if rng.random() < 0.1 else chr(0x4E00 + rng.randrange(3000)) for _ in range(k))
    rows = [(i, text(2000), "zz") for i in range(200)]
    tests = [text(300) for _ in range(4)]
    models = L.train(docs_of(rows))
    clean = L._Letters()
    found, _ = models.cross_entropies([clean(t) for t in tests], len(tests))
    p = plain_model([t for _, t, _ in rows])
    assert found[:, 0] == pytest.approx([plain_entropy(p, t) for t in tests], rel=1e-4)


def identified(docs):
    columns = ("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "accepted")
    rows = L.identify(docs).select(*columns).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[4] or 0))


def test_broadcast_and_joined_models_give_the_same(docs_of, monkeypatch):
    rows = corpus(7, 90) + [(9000, "qxjk zzz 語 wvw", None), (9001, None, "aa"), (9002, "12 -", "bb")]
    rows += [(9003, "one text twice", None)] * 2 + [(None, "no id sch ung lich", "bb")]
    docs = docs_of(rows)
    one = identified(docs)
    monkeypatch.setattr(L, "MOST_ENTRIES", 0)
    two = identified(docs)
    assert isinstance(L.train(docs), L.ModelTable)
    assert len(one) == len(two) == len(rows)
    for a, b in zip(one, two, strict=True):
        assert (*a[:3], a[5]) == (*b[:3], b[5])
        assert b[3:5] == (pytest.approx(a[3], rel=1e-9), a[4] and pytest.approx(a[4], rel=1e-9))


def test_more_languages_than_are_broadcast(docs_of, monkeypatch):
    monkeypatch.setattr(L, "MOST_LANGUAGES", 2)
    rows = corpus(8, 90)
    found = identified(docs_of(rows))
    lang = {d: own for d, _, own in rows}
    assert np.mean([pred == lang[d] for d, _, pred, *_ in found]) > 0.99
