import hashlib
import random
import re

from shoptrail.llm.pii import KINDS, accepted_codes, base_spans, find_pii, luhn


def plain(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def shown(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice("1234.+-() @a.b,é") for _ in range(rng.randrange(40)))
        assert base_spans(text) == plain(text)
    for _ in range(2000):
        text = "".join(rng.choice(["4111", " ", "-", "1111", "+1", "x", "5", "00"]) for _ in range(12))
        assert base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "+1 " * 100_000, "@a." * 100_000):
        base_spans(text)


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_numbers_that_run_into_each_other_are_added(docs_of):
    clean = [(i, f"word +1 (269) 555-{3000 + i} word a{i}@mail.example.com word 10.1.2.{i % 200}") for i in range(200)]
    cards = [(1000 + i, "pay 4111111111111111 now") for i in range(60)]
    merged = (5000, "é +1 (269) 555-3296 4111111111111111 end")
    token = (5001, 'token = "18945874088f67dc02ebee7da32856e8cab6"')
    rows = [*clean, *cards, merged, token, (5002, None), (5003, "")]
    found = {r["doc_id"]: r for r in find_pii(docs_of(rows)).collect()}
    for d, text in rows:
        base = plain(text or "")
        row = found[d]
        assert [row[f"n_{k}"] for k in KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        assert row["base_sha256"] == hashlib.sha256(shown(base).encode()).hexdigest()
        if d != 5000:
            assert row["spans"] == shown(base) and row["n_added"] == 0
    assert plain(merged[1]) == []
    assert found[5000]["spans"] == "phone:2:19,card:20:36"


def test_no_spans_at_all():
    assert accepted_codes({}) == []
