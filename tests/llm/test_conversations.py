import hashlib
import zlib
from collections import defaultdict

import pytest
from given import TESTDATA

from shoptrail.llm import conversations as module
from shoptrail.llm.conversations import Solver, repair_digests

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
    "repaired_sha256",
]
BLANKS = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        mine = out[conv]
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        if kind:
            mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    for mine in out.values():
        mine.sort(
            key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest())
        )
    return out


def plain_faults(turns):
    seen, faults = set(), []
    for _, role, text in turns:
        bare = text.strip(BLANKS)
        fault = (
            "blank" if not bare
            else "duplicate" if (role, text) in seen
            else "truncated" if bare[-1] not in ".!?"
            else ""
        )
        seen.add((role, text))
        faults.append(fault)
    return faults


def plain_best(classes, faults):
    """Least ``(cost, audit)`` by trying every edit from every state, turn after turn."""
    moves = {"": "su", "s": "u", "u": "a", "a": "u"}
    after = {"": (0, ""), "s": (4, "II"), "u": (2, "I"), "a": (0, "")}
    for c, fault in zip(reversed(classes), reversed(faults)):
        here = {}
        for state, legal in moves.items():
            ways = [(3 + after[state][0], "D" + after[state][1])]
            if fault not in ("blank", "duplicate"):
                left = int(fault == "truncated")
                if c and c in legal:
                    ways.append((left + after[c][0], "K" + after[c][1]))
                other = after[legal[-1]]
                ways.append((2 + left + other[0], "R" + other[1]))
            here[state] = min(ways)
        for _ in range(3):
            for state, legal in moves.items():
                cost, audit = here[legal[-1]]
                here[state] = min(here[state], (2 + cost, "I" + audit))
        after = here
    return after[""]


def plain_digests(rows):
    for conv, turns in plain_damage(rows).items():
        faults = plain_faults(turns)
        initials = [role[:1] for _, role, _ in turns]
        cost, audit = plain_best(initials, faults)
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        lines, state, at = [], "", 0
        for edit in audit:
            want = {"a": "user", "u": "assistant"}.get(state, "user")
            if edit == "I":
                lines.append(f"{want}:")
                state = want[0]
                continue
            _, role, text = turns[at]
            at += 1
            if edit != "D":
                role = want if edit == "R" else role
                lines.append(f"{role}:{text}")
                state = role[0]
        assert at == len(turns)
        yield (
            conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal,
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )


def check(df, rows):
    found = [tuple(r) for r in repair_digests(df).select(*COLUMNS).collect()]
    assert sorted(found, key=repr) == sorted(plain_digests(rows), key=repr)
    return found


def test_given_conversations(spark):
    df = spark.read.parquet(f"{TESTDATA}/../sf0.01/conversations.parquet")
    found = check(df, [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    edits = "".join(r[7] for r in found)
    assert all(e in edits for e in "DIKR")


def made(rows_of=60, conv=1):
    """A conversation with every kind of turn, from a plain rule."""
    roles = ["user", "assistant", "system", "tool", "user", "user", "assistant", ""]
    texts = ["One.", "Two", "", "Three!", "Four?", " \t", "Five", "Six.", None]
    return [
        (conv, t, roles[(t * t + t // 7) % len(roles)], f"{texts[(3 * t + t // 5) % len(texts)] or ''}"
         if t % 3 else f"{t}{texts[t % 8]}")
        for t in range(rows_of)
    ]


@pytest.mark.parametrize("limits", [(4096, 1 << 22, 1024), (5, 1 << 22, 2), (4096, 30, 3)])
def test_chunks_and_partitions_change_nothing(spark, monkeypatch, limits):
    """A conversation with most of all turns spans chunks and tasks."""
    for name, value in zip(("CHUNK_TURNS", "CHUNK_CHARS", "UNROLLED"), limits):
        monkeypatch.setattr(module, name, value)
    rows = made(400) + [r for c in range(2, 40) for r in made(c % 9, c)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(7), rows)


def test_common_texts_by_join_and_by_broadcast(spark, monkeypatch):
    rows = made(200) + made(150, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    for most in (1, 20, 100_000):
        monkeypatch.setattr(module, "FREQUENT", most)
        check(df, rows)


def test_odd_rows(spark):
    """Nulls in every column, empty and very long texts, ties, repeats, a lone conversation."""
    rows = [
        (None, None, None, None), (None, 3, "user", "Who?"), (None, 3, "user", "Who?"),
        (5, None, "system", "Rule."), (5, None, "user", "Before."), (5, 1, "assistant", None),
        (5, 2, None, "No role"), (6, 1, "user", ""), (7, 9, "user", "x" * 300_000 + "."),
        (7, 10, "assistant", "y. " * 50_000), (7, 10, "assistant", "tie."), (7, -4, "tool", "é ü."),
        (8, -(2**63), "user", "First."), (8, 2**63 - 1, "assistant", "Last."),
        (9, 1, "system", "Alone."), *[(10, t, "user", "Same.") for t in range(50)],
        *[(11, 1, "assistant", "Copy.")] * 30, *[(c, 0, "user", "Drop?") for c in range(100, 160)],
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", *[f"turn as `{c}`" for c in ("conv", "part", "seq", "symbol", "n", "digest", "kind")]
    )
    expected = sorted(plain_digests(rows), key=repr)
    expected = [(*r[:1], min(r[1], 2**63 - 1), *r[2:]) for r in expected]
    found = [tuple(r) for r in repair_digests(df).select(*COLUMNS).collect()]
    assert sorted(found, key=repr) == expected
    empty = [r for r in found if r[7] == ""]
    assert empty and all(r[8] == hashlib.sha256(b"").hexdigest() for r in empty)


def test_empty_table(spark):
    assert repair_digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_runs_cost_their_digits():
    """A run of a billion questions is carried over in thirty steps."""
    solver = Solver()
    run = (module.symbol(1, module.FINE), 10**9)
    # Every other question is cheapest reroled to an answer.
    assert solver.before(run, module.AT_END)[module.START] == 10**9
    assert len(solver.powers[run[0]]) == 30


def test_every_short_sequence():
    """All sequences of up to four turns against trying every edit."""
    from itertools import product

    solver = Solver()
    names, kinds = "suax", ["", "blank", "duplicate", "truncated"]
    for n in range(5):
        for turns in product(range(16), repeat=n):
            if n == 4 and sum(turns) % 7:
                continue
            cost, edits = solver.solve([(t, 1) for t in turns])
            expected = plain_best([names[t // 4] for t in turns], [kinds[t % 4] for t in turns])
            assert (cost, "".join(edits)) == expected
