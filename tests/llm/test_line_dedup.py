import random
from string import ascii_lowercase, ascii_uppercase

from shoptrail.llm import line_dedup
from shoptrail.llm.line_dedup import dedup_lines

LOW = str.maketrans(ascii_uppercase, ascii_lowercase)


def plain(rows, least=10):
    key = lambda line: line.strip("\x20\t\n\x0b\x0c\r").translate(LOW)
    seen = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                seen.setdefault(key(line), set()).add(d)
    result = {}
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(seen.get(key(x), ())) < 2 or min(seen[key(x)]) == d]
        result[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return result


def corpus(seed, n):
    """A line in a third of all documents, others in a few, short ones everywhere."""
    rng = random.Random(seed)
    lines = [f"Line number {i} of all É" for i in range(n)] + ["short", "", "  ", "ÀÉÎ short"]
    rows = []
    for d in range(n):
        own = rng.choices(lines, k=rng.randint(0, 12))
        if d % 3 == 0:
            own.insert(rng.randint(0, len(own)), rng.choice([" The hot line. ", "THE HOT line.\t"]))
        rows.append((1000 - d, "\n".join(rng.choice([x, x.upper(), x + " "]) for x in own)))
    return [*rows, (5000, None), (5001, ""), (5002, "\n\n"), (5003, "The hot line.")]


def check(docs_of, rows):
    found = dedup_lines(docs_of(rows)).collect()
    assert {
        r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in found
    } == plain(rows)
    for r in found:
        kept = [i for run in r["kept_runs"] for i in range(run["start"], run["start"] + run["n"])]
        lines = (dict(rows)[r["doc_id"]] or "").split("\n")
        assert "\n".join(lines[i - 1] for i in kept) == r["text"]


def test_against_brute_force(docs_of):
    check(docs_of, corpus(1, 400))


def test_without_the_sketch_of_hot_lines(docs_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "_may_be_hot", lambda lines: lines.select("h1").limit(0))
    check(docs_of, corpus(2, 300))


def test_no_row_moves_twice_for_the_window(docs_of):
    docs = line_dedup._keyed(docs_of(corpus(3, 50)))
    plan = line_dedup._dropped(line_dedup._lines(docs, 10))._jdf.queryExecution().toString()
    late = plan.split("Physical Plan")[1].split("Window")[1].split("BroadcastHashJoin")[0]
    assert late.count("Exchange") == 1 and "rangepartitioning" in late
