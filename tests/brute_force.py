"""Brute-force answers in plain Python, for small fixtures only."""

from collections import Counter, defaultdict
from itertools import combinations


def id_key(s):
    try:
        if not s.strip("+-0123456789"):
            return (False, int(s), s)
    except ValueError:
        pass
    return (True, 0, s)


def items_of(pairs):
    out = defaultdict(set)
    for u, i in pairs:
        out[u].add(i)
    return out


def top_pairs(pairs, top):
    counts = Counter()
    for items in items_of(pairs).values():
        counts.update(combinations(sorted(items, key=id_key), 2))
    ranked = sorted(counts.items(), key=lambda kv: (-kv[1], id_key(kv[0][0]), id_key(kv[0][1])))
    return [(a, b, n) for (a, b), n in ranked[:top]]


def walk(pairs, target, alpha=0.85, max_iter=20, tol=1e-6):
    """Ranks and the number of rounds, by the round-by-round definition."""
    out = defaultdict(list)
    for u, i in set(pairs):
        out["user", u].append(("item", i))
        out["item", i].append(("user", u))
    ranks = {("user", target): 1.0}
    rounds = 0
    for rounds in range(1, max_iter + 1):
        moved = defaultdict(float)
        for node, rank in ranks.items():
            for other in out[node]:
                moved[other] += alpha * rank / len(out[node])
        moved["user", target] += 1 - alpha
        shift = max(abs(moved.get(n, 0.0) - ranks.get(n, 0.0)) for n in {*moved, *ranks})
        ranks = dict(moved)
        if shift <= tol:
            break
    return ranks, rounds
