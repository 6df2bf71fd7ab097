import random

from shoptrail.llm import token_counts as T

SCORES = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁a": -2.2, "bab": -4.0, "é": -5.0, "aaaa": -4.1}


def plain(word, scores):
    text = "▁" + word
    byte, best = min(scores.values()), [(0.0, 0)]
    for end in range(1, len(text) + 1):
        n = len(text[end - 1].encode())
        options = [(best[end - 1][0] + n * byte, best[end - 1][1] - n)]
        for start in range(end):
            if text[start:end] in scores:
                options.append((best[start][0] + scores[text[start:end]], best[start][1] - 1))
        best.append(max(options))
    return -best[-1][1]


def words(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choices("aabbé語c", k=rng.randint(1, 14))) for _ in range(n)]


def test_counts_equal_the_whole_table():
    counter = T.WordCounter(SCORES)
    for w in words(1):
        assert counter.total([w.encode()] * 2) == 2 * plain(w, SCORES)


def test_small_tries_and_long_words_count_alike(monkeypatch):
    monkeypatch.setattr(T, "MOST_NODES", 20)
    monkeypatch.setattr(T, "LONGEST_IN_TRIE", 6)
    counter = T.WordCounter(SCORES)
    for w in words(2):
        assert counter.total([w.encode()]) == plain(w, SCORES)
    assert len(counter.score) < 20 + 8


def test_with_a_public_vocabulary(docs_of):
    scores = T.piece_scores()
    texts = ["Hello world, this is a small text.", "", None, "été 語 ☃ x\ty", "tokenization"]
    found = T.token_counts(docs_of(list(enumerate(texts)))).collect()
    for r in found:
        own = (texts[r["doc_id"]] or "").split()
        assert r["n_words"] == len(own)
        assert r["n_tokens"] == sum(plain(w, scores) for w in own)
