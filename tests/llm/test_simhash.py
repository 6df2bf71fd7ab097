import random

import numpy as np
import xxhash

from shoptrail.llm.components import connected
from shoptrail.llm.simhash import _Golay, fingerprint, join_keys, links, simhash_groups

BLANKS = " \t\n\x0b\x0c\r"


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for b in BLANKS:
        low = low.replace(b, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def unsigned(x):
    return x & (1 << 64) - 1


def components(prints, bits):
    """Union by comparing all pairs; a root is the least signed fingerprint."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and bin(unsigned(a) ^ unsigned(b)).count("1") <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in prints}


def clouds(seed, n, size, reach):
    """Fingerprints around random centres, with chains."""
    rng = random.Random(seed)
    found = set()
    for _ in range(n):
        p = rng.getrandbits(64)
        for _ in range(size):
            found.add(p if p < 1 << 63 else p - (1 << 64))
            for b in rng.sample(range(64), rng.randint(1, reach)):
                p ^= 1 << b
    return sorted(found)


def test_fingerprints_equal_the_definition():
    rng = random.Random(3)
    texts = ["", " \n", "one", "A b C", "É a ÀB c d", "a b c d", "x" * 9]
    texts += [
        "".join(rng.choice(["ab", "Cd", "é", *BLANKS, "  "]) for _ in range(rng.randint(1, 200)))
        for _ in range(60)
    ]
    for t in texts:
        assert unsigned(fingerprint(t.encode())) == plain_fingerprint(t)


def test_long_texts_in_parts():
    text = " ".join(str(i % 977) for i in range(150_000))
    assert unsigned(fingerprint(text.encode())) == plain_fingerprint(text)


def test_golay_code_is_perfect():
    golay = _Golay()
    words = np.arange(1 << 23, dtype=np.int64)
    code = words ^ golay.error[golay.low[words & 0xFFF] ^ golay.high[words >> 12]]
    assert len(np.unique(code)) == 1 << 12
    assert len(np.unique(code >> 11)) == 1 << 12
    assert np.bitwise_count(golay.error).max() == 3


def test_all_error_patterns_share_a_key():
    rng = np.random.default_rng(5)
    golay = _Golay()
    for _ in range(400):
        p = rng.integers(-(1 << 63), (1 << 63) - 1, 1, dtype=np.int64)
        flips = rng.choice(64, rng.integers(1, 5), replace=False).astype(np.uint64)
        q = (p.view(np.uint64) ^ np.bitwise_or.reduce(np.uint64(1) << flips)).view(np.int64)
        one, two = (set(join_keys(x, golay)[0].tolist()) for x in (p, q))
        assert one & two


def check_links(spark, prints, block):
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    found = {tuple(r) for r in links(df, 4, block).collect()}
    assert all(bin(unsigned(a) ^ unsigned(b)).count("1") <= 4 for a, b in found)
    pairs = spark.createDataFrame(list(found), "a long, b long")
    roots = {r[0]: r[1] for r in connected(pairs).collect()}
    assert {p: roots.get(p, p) for p in prints} == components(prints, 4)


def test_links_connect_what_brute_force_connects(spark):
    check_links(spark, clouds(1, 40, 12, 4) + [0, 1, 3, 7], 8192)


def test_large_keys_in_blocks(spark):
    check_links(spark, clouds(2, 3, 120, 1), 10)


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001)]
    found = {tuple(r) for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(1, n)} | {(1001, 1000)}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_groups_of_documents(docs_of):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choices(vocabulary, k=300)) for _ in range(12)]
    rows = []
    for i in range(120):
        words = base[i % 12].split()
        for _ in range(rng.choice([0, 0, 1, 1, 8])):
            words[rng.randrange(300)] = rng.choice(vocabulary)
        rows.append((1000 - i, " ".join(words)))
    prints = {d: fingerprint(t.encode()) for d, t in rows}
    roots = components(sorted(set(prints.values())), 4)
    least = {}
    for d, p in prints.items():
        least[roots[p]] = min(least.get(roots[p], d), d)
    found = {r["doc_id"]: r for r in simhash_groups(docs_of(rows)).collect()}
    for d, p in prints.items():
        assert found[d]["fingerprint"] == f"{unsigned(p):016x}"
        assert found[d]["component_id"] == least[roots[p]]
