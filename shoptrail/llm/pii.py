"""Personal data in texts: fixed patterns, and a classifier taught by weak votes.

Base spans are exact patterns and always stay. Looser patterns propose more:
numbers that run into each other, addresses in disguise. Six labellers vote on
every span or abstain: the strict pattern, its structure, gazetteers, the words
before it, its borders and its layout. Expectation-maximisation over all spans
estimates how reliable each labeller is, and a logistic classifier is trained on
the posteriors; proposed spans that it finds likely are added.

Texts are scanned once. What goes on is a row per document with its spans, and
the training sees only how often each vote pattern occurs.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import documents, per_text
from shoptrail.llm.voting import ABSTAIN, AGAINST, FOR, estimate
from shoptrail.sources.durable import durable

KINDS = ("email", "ip", "card", "phone")
LABELLERS = ("pattern", "structure", "gazetteer", "context", "borders", "layout")
ADD_FROM = 0.8

# The base patterns. Lookbehinds and possessive repeats give the same leftmost
# matches as without them, in time that is linear in any text.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser ones, each of bounded length.
_LOOSE = (
    ("email", re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}"
        r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}){1,5}")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])")),
    ("card", re.compile(
        r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}"
        r"|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{4,5})(?![0-9])")),
    ("phone", re.compile(
        r"(?<![0-9A-Za-z+])(?:\+?[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-]?"
        r"[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])")),
)

# Gazetteers: common top-level domains, issuer prefixes, country codes.
_DOMAINS = frozenset("com org net edu gov io co uk de fr es it nl eu info us ca au jp ch at be".split())
_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "38", "6011", "65", "35", "22", "62")
_COUNTRIES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43",
              "44", "45", "46", "47", "48", "49", "52", "54", "55", "56", "57", "60", "61", "62",
              "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "98")
_HINTS = re.compile(
    r"\b(?:call|tel|phone|mobile|fax|cell|e-?mail|mail|contact|card|visa|mastercard|credit|ip"
    r"|address|host|from|reach)\b[^A-Za-z0-9]{0,4}\Z", re.I)
_COUNTER_HINTS = re.compile(
    r"(?:\b(?:version|ver|v|section|isbn|order|invoice|no|page|chapter|rfc|release|sku|item|id)\b"
    r"[^A-Za-z0-9]{0,4}|[$€£#])\Z", re.I)
_LAYOUTS = {
    "email": re.compile(r"[a-z][a-z0-9]*(?:[._+-][a-z0-9]+)*@[a-z0-9.-]+", re.I),
    "ip": re.compile(r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}"),
    "card": re.compile(r"[0-9]{14,19}|[0-9]{4}(?:\x20[0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}"),
    "phone": re.compile(
        r"\+[0-9]{10,15}|(?:\+?[0-9]{1,3}[\x20.-])?\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}"
        r"|(?:\+?[0-9]{1,3}([\x20.-]))?[0-9]{3}([\x20.-])[0-9]{3}\2[0-9]{4}"
        r"|\+[0-9]{1,3}(?:\x20[0-9]{2,4}){2,5}"),
}


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = (int(c) * 2 for c in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _small_parts(text: str) -> bool:
    parts = (p.lstrip("0") for p in text.split("."))
    return all(len(p) < 4 and int(p or "0") <= 255 for p in parts)


def _emails(text: str) -> list[tuple[int, int]]:
    """From each @ backwards and forwards, which is where a leftmost match can be."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        low = at
        while low > end and _LOCAL.match(text, low - 1, low):
            low -= 1
        domain = _DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            end = domain.end()
            found.append((low, end))
            at = text.find("@", end)
        else:
            end = max(end, at + 1)
            at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in order, kinds by their place in ``KINDS``."""
    found = [(low, 0, high) for low, high in _emails(text)] if "@" in text else []
    if _ANY_DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _small_parts(m[0])]
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() < 40 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


_ANY_DIGIT = re.compile("[0-9]")
_DISGUISE = re.compile(r"[\[(]at[\])]")


def _proposed(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the looser patterns that meet no base span and no span before them."""
    taken, found = bytearray(len(text)), []
    for low, _, high in base:
        taken[low:high] = b"\1" * (high - low)
    for kind, pattern in _LOOSE:
        if kind == "email" and not _DISGUISE.search(text):
            continue
        for m in pattern.finditer(text):
            low, high = m.span()
            if not any(taken[low:high]):
                taken[low:high] = b"\1" * (high - low)
                found.append((low, KINDS.index(kind), high))
    return found


def _yes(test: bool) -> int:
    return FOR if test else AGAINST


def span_votes(text: str, low: int, kind: int, high: int, strict: bool) -> list[int]:
    """The votes of ``LABELLERS`` on one span."""
    span, name = text[low:high], KINDS[kind]
    digits = _digits(span)
    if name == "email":
        plain = re.sub(r"\x20?[\[(]dot[\])]\x20?", ".", span)
        structure = _yes("." in plain and not plain.endswith((".", "-")))
        known = FOR if plain.rpartition(".")[2].lower() in _DOMAINS else ABSTAIN
    elif name == "ip":
        structure = _yes(_small_parts(span))
        known = _yes(not span.startswith(("0.", "255.")))
    elif name == "card":
        structure = _yes(luhn(digits))
        known = FOR if digits.startswith(_ISSUERS) else AGAINST
    else:
        structure = _yes(10 <= len(digits) <= 15)
        abroad = span.startswith("+")
        known = _yes(digits.startswith(_COUNTRIES)) if abroad else ABSTAIN
    before = text[max(0, low - 30) : low]
    context = FOR if _HINTS.search(before) else AGAINST if _COUNTER_HINTS.search(before) else ABSTAIN
    around = text[low - 1 : low] + text[high : high + 1]
    glued = any(c.isalnum() or c in "_/=" for c in around)
    return [
        FOR if strict else ABSTAIN,
        structure,
        known,
        context,
        _yes(not glued),
        _yes(bool(_LAYOUTS[name].fullmatch(span))),
    ]


def _code(kind: int, votes: list[int]) -> int:
    code = kind
    for vote in votes:
        code = code * 3 + vote + 1
    return code


def _decode(code: int) -> tuple[int, list[int]]:
    votes = []
    for _ in LABELLERS:
        code, vote = divmod(code, 3)
        votes.append(vote - 1)
    return code, votes[::-1]


def _text_of(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{low}:{high}" for low, kind, high in spans)


def _scan(raw: bytes) -> tuple:
    text = raw.decode("utf-8", "replace")
    base = base_spans(text)
    more = _proposed(text, base) if _ANY_DIGIT.search(text) or _DISGUISE.search(text) else []
    flat: list[int] = []
    for strict, (low, kind, high) in [*((True, s) for s in base), *((False, s) for s in more)]:
        flat += [low, kind, high, _code(kind, span_votes(text, low, kind, high, strict)), int(strict)]
    counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
    return (*counts, hashlib.sha256(_text_of(base).encode()).hexdigest(), flat)


def _features(codes: list[int]) -> np.ndarray:
    """Of span codes: which way each labeller votes, and the kind."""
    rows = []
    for kind, votes in map(_decode, codes):
        row = [1.0, *(float(kind == k) for k in range(1, len(KINDS)))]
        # The strict pattern is what the classifier is to do without.
        row += [float(v == side) for v in votes[1:] for side in (FOR, AGAINST)]
        rows.append(row)
    return np.array(rows)


def _logistic(x: np.ndarray, wanted: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights by Newton's method, with a ridge of one row's weight."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (wanted - p)) - w
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def accepted_codes(counts: dict[int, int], add_from: float = ADD_FROM) -> list[int]:
    """Codes the classifier finds likely, taught by the votes seen ``counts`` times."""
    codes = sorted(counts)
    if not codes:
        return []
    n = np.array([counts[c] for c in codes], float)
    patterns = np.array([_decode(c)[1] for c in codes])
    posterior = estimate(patterns, n, share=0.5).posterior(patterns)
    x = _features(codes)
    p = 1 / (1 + np.exp(-np.clip(x @ _logistic(x, posterior, n), -30, 30)))
    return [c for c, likely in zip(codes, p.tolist(), strict=True) if likely >= add_from]


def _spans(flat: str):
    """The flat numbers of a row as spans, five for each."""
    places = F.sequence(F.lit(1), F.floor(F.size(flat) / 5).cast("int"))
    none = F.slice(F.array(F.lit(0)), 1, 0)
    return F.transform(
        F.transform(F.when(F.size(flat) > 0, places).otherwise(none), lambda i: i - 1),
        lambda i: F.struct(
            *[F.get(flat, i * 5 + k).alias(c) for k, c in enumerate(("start", "kind", "end", "code"))],
            (F.get(flat, i * 5 + 4) == 1).alias("base"),
        ),
    )


def find_pii(docs: DataFrame, add_from: float = ADD_FROM) -> DataFrame:
    """Per row: ``doc_id``, base counts by kind, ``base_sha256``, ``spans``, ``n_added``.

    ``n_email`` to ``n_phone`` and the digest are of base spans alone. ``spans``
    lists all as ``kind:start:end`` by start, then kind, in code points with the
    end exclusive. Base spans of different kinds may overlap; added ones overlap
    no other. Null texts count as empty and have no span; texts are scanned
    whole. Repeated rows each get a row, other columns are ignored.
    """
    schema = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, flat array<long>"
    scanned = durable(per_text(documents(docs), _scan, schema), "spans")
    rows = scanned.withColumn("all", _spans("flat"))
    # A row per code, at most 4 * 3 ** 6.
    counts = rows.select(F.explode("all").alias("s")).groupBy("s.code").count().collect()
    good = accepted_codes({r["code"]: r["count"] for r in counts}, add_from)
    kept = F.filter("all", lambda s: s["base"] | s["code"].isin(good))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(
        F.array_sort("kept"),
        lambda s: F.concat_ws(
            ":", F.get(names, s["kind"].cast("int")), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return rows.withColumn("kept", kept).select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        "base_sha256",
        F.array_join(text, ",").alias("spans"),
        F.size(F.filter("kept", lambda s: ~s["base"])).cast("bigint").alias("n_added"),
    )
