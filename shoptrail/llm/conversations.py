"""Repair of conversations at the least cost, by dynamic programming over runs.

A turn is one of few symbols: its role's initial and its fault. Equal neighbours are a run.
A symbol's step is a 4 x 4 matrix of costs between the states of ``(s?(ua)+)?``, under the
sum that takes the minimum; powers of it for 1, 2, 4 ... turns are made once and carry the
costs over a run in as many products as its length has binary digits. Then choices are
unrolled from the front: of the edits that keep the total least, the one whose initial
sorts first.

Turns are range-partitioned and sorted, so a conversation may span tasks. One that lies
within a task, and in the memory a task gives it, is solved there. Any other leaves chunks:
its runs, without texts, meet in one place (they are as long as the audit, which is one
value), while its texts stay in chunks, to which their parts of the audit go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import BLANKS, bound_batches
from shoptrail.sources.durable import durable

ROLES = "sua"  # classes 0 to 2; 3 is any other initial
OTHER = 3
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)  # states, by what the repaired turns end with
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEXT = (USER, USER, ASSISTANT, USER)  # what an inserted or a reroled turn leads to
KEPT = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})  # by state and class
LEGAL = {(0, 1), (1, 2), (2, 1)}
NEVER = 1 << 60
# Turns and characters of one conversation that a task holds; turns unrolled at once.
CHUNK_TURNS, CHUNK_CHARS = 4096, 1 << 22
UNROLLED = 1024
# A text in more than this share of all turns is frequent, so at most as many are.
FREQUENT = 100_000

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]
Run = tuple[int, int]  # symbol, turns

# From each state to the end: an open question needs an answer, a lone system turn both.
AT_END: Vector = (0, 2 * INSERT, INSERT, 0)


def symbol(role_class: int, fault: int) -> int:
    return role_class * 4 + fault


def _edits(role_class: int, fault: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a turn in the order of their initials: ``(initial, cost, next state)``."""
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    left = LEFT_TRUNCATED if fault == TRUNCATED else 0
    if role_class in KEPT[state]:
        yield "K", left, KEPT[state][role_class]
    yield "R", REROLE + left, NEXT[state]


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v, strict=True)) for row in a)


class Solver:
    """Least costs and edits of sequences of runs, with powers kept for all of them."""

    def __init__(self) -> None:
        insert = [[0 if i == j else NEVER for j in range(4)] for i in range(4)]
        for i in range(4):
            one = NEXT[i]
            insert[i][one] = min(insert[i][one], INSERT)
            insert[i][NEXT[one]] = min(insert[i][NEXT[one]], 2 * INSERT)
        self.insert: Matrix = tuple(map(tuple, insert))
        self.powers: dict[int, list[Matrix]] = {}

    def _power(self, of: int, k: int) -> Matrix:
        """The costs of 2 ** k turns of a symbol, inserted turns before each included."""
        known = self.powers.setdefault(of, [])
        if not known:
            step = [[NEVER] * 4 for _ in range(4)]
            for state in range(4):
                for _, cost, then in _edits(*divmod(of, 4), state):
                    step[state][then] = min(step[state][then], cost)
            known.append(_product(self.insert, tuple(map(tuple, step))))
        while len(known) <= k:
            known.append(_product(known[-1], known[-1]))
        return known[k]

    def before(self, run: Run, after: Vector) -> Vector:
        """Costs to the end from before a run, given those from after it."""
        of, n = run
        for k in range(n.bit_length()):
            if n >> k & 1:
                after = _apply(self._power(of, k), after)
        return after

    def solve(self, runs: list[Run]) -> tuple[int, list[str]]:
        """The least cost, and the edits within each run; those after the last come last."""
        costs = [AT_END]
        for run in reversed(runs):
            costs.append(self.before(run, costs[-1]))
        costs.reverse()
        state, audit = START, []
        for run, after in zip(runs, costs[1:], strict=True):
            made: list[str] = []
            state = self._unroll(run, after, state, made)
            audit.append("".join(made))
        audit.append("I" * (AT_END[state] // INSERT))
        return costs[0][START], audit

    def _unroll(self, run: Run, after: Vector, state: int, made: list[str]) -> int:
        """The state after a run whose edits, least in letters, are added to ``made``."""
        of, n = run
        role_class, fault = divmod(of, 4)
        if fault in (BLANK, DUPLICATE):  # what is inserted may as well come later
            made.append("D" * n)
            return state
        if n > UNROLLED:
            half = n // 2
            middle = self.before((of, n - half), after)
            state = self._unroll((of, half), middle, state, made)
            return self._unroll((of, n - half), after, state, made)
        rest = [after]
        for _ in range(n):
            rest.append(_apply(self._power(of, 0), rest[-1]))
        for left in range(n, 0, -1):
            here, then = rest[left], rest[left - 1]
            while True:
                choices = {e: (c + then[q], q) for e, c, q in _edits(role_class, fault, state)}
                best = [e for e, (total, _) in choices.items() if total == here[state]]
                if "D" not in best and INSERT + here[NEXT[state]] == here[state]:
                    made.append("I")
                    state = NEXT[state]
                    continue
                made.append(best[0])
                state = choices[best[0]][1]
                break
        return state


def repaired_turns(
    audit: str, state: int, faults: Iterator[int], turns: Iterator[tuple[str, str]]
) -> tuple[list[str], list[str], int]:
    """Roles and texts that a piece of an audit leaves, and the state it ends in.

    ``faults`` has one for each turn; ``turns`` has role and text of those that have to be
    neither blank nor a duplicate.
    """
    roles, texts = [], []
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            roles.append(NAMES[state])
            texts.append("")
            continue
        if next(faults) in (BLANK, DUPLICATE):
            continue
        role, text = next(turns)
        if edit == "D":
            continue
        if edit == "K":
            state = KEPT[state][_class_of(role)]
        else:
            state = NEXT[state]
            role = NAMES[state]
        roles.append(role)
        texts.append(text)
    return roles, texts, state


def _class_of(role: str) -> int:
    found = ROLES.find(role[0]) if role else -1
    return OTHER if found < 0 else found


def _faults(runs: list[Run]) -> Iterator[int]:
    for of, n in runs:
        for _ in range(n):
            yield of % 4


@dataclass
class Counts:
    """What is counted along the runs of a conversation."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    last: int | None = None

    def add(self, runs: list[Run]) -> None:
        for of, n in runs:
            role_class, fault = divmod(of, 4)
            self.blank += n * (fault == BLANK)
            self.duplicate += n * (fault == DUPLICATE)
            self.truncated += n * (fault == TRUNCATED)
            self.illegal += n - 1  # no role may follow itself
            if self.last is not None:
                self.illegal += (self.last, role_class) not in LEGAL
            self.last = role_class

    def values(self) -> tuple[int, ...]:
        return self.blank, self.duplicate, self.truncated, self.illegal


# -- Turns: damage, faults, order ---------------------------------------------------------


def plain_turns(conversations: DataFrame) -> DataFrame:
    """``(conv, turn, role, text, copies)``: a null id, role or text is one space."""
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).cast("bigint").alias("copies"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults dealt by a hash of conversation and turn: five kinds in twenty."""
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat("conv", F.lit(":"), turn)) % 20
    return (
        turns.withColumn("kind", kind)
        .where(F.col("kind") != 0)
        .select(
            "conv",
            "turn",
            F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, F.lit(""))
            .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.when(F.col("kind") == 3, F.col("copies") * 2)
            .otherwise(F.col("copies"))
            .alias("copies"),
        )
    )


def _stripped() -> Column:
    return F.rtrim(F.col("text"), F.lit(BLANKS))


def _with_repeats(turns: DataFrame) -> DataFrame:
    """Distinct turns with ``n``, and ``seen``: whether an earlier turn says the same.

    Equal turns of one number are one row. Texts that only one turn of a conversation has
    are no repeats, so few rows meet their first turn: those of frequent texts by a
    broadcast, the rest in a join without hot keys.
    """
    key = ["conv", "role", "digest"]
    rows = durable(
        turns.groupBy("conv", "turn", "role", "text")
        .agg(F.sum("copies").alias("n"))
        .withColumn("blank", F.length(_stripped()) == 0)
        .withColumn("digest", F.sha2("text", 256)),
        "turns",
    )
    firsts = durable(
        rows.where(~F.col("blank"))
        .groupBy(*key)
        .agg(
            F.min("turn").alias("first"),
            F.max(F.col("turn").isNull()).alias("none_first"),
            F.count(F.lit(1)).alias("rows"),
        )
        .where(F.col("rows") > 1),
        "first-turns",
    )
    later = F.when(F.col("none_first"), F.col("turn").isNotNull()).otherwise(
        F.col("turn") > F.col("first")
    )
    total = firsts.agg(F.sum("rows")).first()[0]
    if not total:
        return rows.withColumn("seen", F.lit(False))
    often = F.col("rows") * FREQUENT > F.lit(total)
    hot, cold = F.broadcast(firsts.where(often)), firsts.where(~often)
    seen = F.coalesce(later, F.lit(False)).alias("seen")
    known = rows.join(hot, key).select(*rows.columns, seen)
    others = rows.join(hot.select(*key), key, "left_anti")
    if cold.isEmpty():
        return known.unionByName(others.withColumn("seen", F.lit(False)))
    return known.unionByName(others.join(cold, key, "left").select(*rows.columns, seen))


def _with_symbols(rows: DataFrame) -> DataFrame:
    """``symbol`` of a row's first turn, and whether its other copies are blank."""
    initial = F.substring("role", 1, 1)
    role_class = F.lit(OTHER)
    for i, letter in enumerate(ROLES):
        role_class = F.when(initial == letter, F.lit(i)).otherwise(role_class)
    fault = (
        F.when(F.col("blank"), F.lit(BLANK))
        .when(F.col("seen"), F.lit(DUPLICATE))
        .when(~F.right(_stripped(), F.lit(1)).isin(".", "!", "?"), F.lit(TRUNCATED))
        .otherwise(F.lit(FINE))
    )
    kept = ~F.col("blank") & ~F.col("seen")
    return rows.select(
        "conv",
        "turn",
        "role",
        (role_class * 4 + fault).alias("symbol"),
        "n",
        F.when(kept, F.col("text")).alias("text"),
        "digest",
    )


# -- One pass over sorted turns -----------------------------------------------------------

_SOLVED = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_CHUNK = (
    "conv string, part int, seq long, whole boolean, symbols array<int>, lengths array<long>, "
    f"roles array<string>, texts array<string>, {_SOLVED}"
)


class _Open:
    """The turns of a conversation that a task has read and not given out."""

    def __init__(self, conv: str) -> None:
        self.conv, self.seq = conv, 0
        self.clear()

    def clear(self) -> None:
        self.runs: list[Run] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.chars = 0

    def _run(self, of: int, n: int) -> None:
        if self.runs and self.runs[-1][0] == of:
            n += self.runs.pop()[1]
        self.runs.append((of, n))

    def add(self, of: int, n: int, role: str, text: str | None) -> None:
        role_class, fault = divmod(of, 4)
        self._run(of, 1)
        if n > 1:
            self._run(symbol(role_class, BLANK if fault == BLANK else DUPLICATE), n - 1)
        if text is not None:
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)

    def full(self) -> bool:
        return (
            len(self.texts) >= CHUNK_TURNS
            or len(self.runs) >= CHUNK_TURNS
            or self.chars >= CHUNK_CHARS
        )

    def chunk(self, part: int) -> tuple:
        symbols, lengths = [r[0] for r in self.runs], [r[1] for r in self.runs]
        row = (self.conv, part, self.seq, False, symbols, lengths, self.roles, self.texts)
        self.seq += 1
        self.clear()
        return *row, *[None] * 6

    def solved(self, part: int, solver: Solver) -> tuple:
        counts = Counts()
        counts.add(self.runs)
        cost, pieces = solver.solve(self.runs)
        audit = "".join(pieces)
        turns = zip(self.roles, self.texts, strict=True)
        roles, texts, _ = repaired_turns(audit, START, _faults(self.runs), turns)
        row = self.conv, part, 0, True, None, None, roles, texts
        return *row, *counts.values(), cost, audit


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    kinds = {
        "string": pa.string(),
        "int": pa.int32(),
        "long": pa.int64(),
        "boolean": pa.bool_(),
        "array<int>": pa.list_(pa.int32()),
        "array<long>": pa.list_(pa.int64()),
        "array<string>": pa.list_(pa.string()),
    }
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _chars(value: object) -> int:
    if isinstance(value, list):
        return sum(map(_chars, value))
    return len(value) if isinstance(value, str) else 0


def _bounded(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Batches of a few hundred rows, or of one that may be large by itself."""
    held: list[tuple] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += sum(map(_chars, row))
        if len(held) >= 500 or chars >= CHUNK_CHARS:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _read_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        names = ["conv", "part", "symbol", "n", "role", "text"]
        yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Solved conversations and, of those that may go on in another task, chunks."""
    solver = Solver()
    now: _Open | None = None
    first, part = True, 0
    for conv, part, of, n, role, text in _read_turns(batches):
        if now is None or conv != now.conv:
            if now is not None:
                yield now.chunk(part) if first or now.seq else now.solved(part, solver)
                first = False
            now = _Open(conv)
        now.add(of, n, role, text)
        if now.full():
            yield now.chunk(part)
    if now is not None and now.runs:
        yield now.chunk(part)


def _solve_all(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per conversation in chunks: its results, and per chunk its state and edits."""
    solver = Solver()
    for batch in batches:
        for conv, chunks in zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True):
            counts, runs, sizes = Counts(), [], []
            for c in chunks:
                mine = list(zip(c["symbols"], c["lengths"], strict=True))
                counts.add(mine)
                runs += mine
                sizes.append(len(mine))
            cost, edits = solver.solve(runs)
            ends, at, state = edits.pop(), 0, START
            audits = []
            for k, size in enumerate(sizes):
                piece = "".join(edits[at : at + size]) + (ends if k + 1 == len(sizes) else "")
                audits.append((state, piece))
                state = _state_after(piece, state, runs[at : at + size])
                at += size
            states, pieces = zip(*audits, strict=True)
            parts, seqs = [c["part"] for c in chunks], [c["seq"] for c in chunks]
            yield conv, parts, seqs, list(states), list(pieces), *counts.values(), cost


def _state_after(piece: str, state: int, runs: list[Run]) -> int:
    """The state a piece of an audit ends in, from the classes of its turns."""
    classes = (of // 4 for of, n in runs for _ in range(n))
    for edit in piece:
        if edit == "I":
            state = NEXT[state]
            continue
        role_class = next(classes)
        if edit == "K":
            state = KEPT[state][role_class]
        elif edit == "R":
            state = NEXT[state]
    return state


_PIECES = (
    "conv string, parts array<int>, seqs array<long>, states array<int>, audits array<string>, "
    "blank long, duplicate long, truncated long, illegal long, cost long"
)
_TURNS = "conv string, part int, seq long, roles array<string>, texts array<string>"


def _repair_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    names = ["conv", "part", "seq", "symbols", "lengths", "roles", "texts", "state", "piece"]
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            conv, part, seq, symbols, lengths, roles, texts, state, piece = row
            faults = _faults(list(zip(symbols, lengths, strict=True)))
            turns = zip(roles, texts, strict=True)
            yield conv, part, seq, *repaired_turns(piece, state, faults, turns)[:2]


def _mapped(df: DataFrame, rows, schema: str) -> DataFrame:
    return df.mapInArrow(lambda batches: _bounded(rows(batches), schema), schema)


@dataclass
class Repaired:
    """Results per conversation, and the repaired turns in pieces.

    ``results`` has ``(conv, blank, duplicate, truncated, illegal, cost, audit)``, ``turns``
    has ``(conv, part, seq, whole, roles, texts)``: in the order of ``part`` and ``seq``,
    or, where ``whole`` is true, all in one row. ``gaps`` has ``(conv, gaps)``. All three
    leave out conversations without turns.
    """

    results: DataFrame
    turns: DataFrame
    gaps: DataFrame


def repair(turns: DataFrame) -> Repaired:
    """The cheapest repair of each conversation of ``turns`` (as ``plain_turns`` gives them).

    Turns are taken by number, none first; of equal numbers by role, then SHA-256 of the
    text. A turn's first fault counts: blank, said before by the same role, or without an
    end. Keeping a
    turn costs 0, another role 2, deleting 3 (blank and repeated turns must go), inserting
    an empty one 2, and a turn left without its end 1 more. The roles' initials
    are then ``(s?(ua)+)?``; of equal costs the audit that sorts first is taken.
    """
    bound_batches(turns.sparkSession)
    rows = _with_repeats(turns)
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    sorted_rows = (
        _with_symbols(rows)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .select("conv", "part", "symbol", "n", "role", "text")
    )
    chunks = durable(_mapped(sorted_rows, _along, _CHUNK), "chunks")
    whole, split = chunks.where("whole"), chunks.where("not whole")
    runs = split.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("part", "seq", "symbols", "lengths"))).alias("chunks")
    )
    solved = durable(_mapped(runs, _solve_all, _PIECES), "solved-chunks")
    named = ["conv", "blank", "duplicate", "truncated", "illegal", "cost"]
    results = whole.select(*named, "audit").unionByName(
        solved.select(*named, F.array_join("audits", "").alias("audit"))
    )
    pieces = solved.select(
        "conv",
        F.inline(
            F.arrays_zip(
                F.col("parts").alias("part"),
                F.col("seqs").alias("seq"),
                F.col("states").alias("state"),
                F.col("audits").alias("piece"),
            )
        ),
    )
    parts = split.join(pieces, ["conv", "part", "seq"]).select(
        "conv", "part", "seq", "symbols", "lengths", "roles", "texts", "state", "piece"
    )
    of_parts = _mapped(parts, _repair_chunks, _TURNS).withColumn("whole", F.lit(False))
    columns = ["conv", "part", "seq", "whole", "roles", "texts"]
    numbers = rows.groupBy("conv").agg(
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.count_distinct("turn").alias("numbers"),
    )
    wide = F.col("high").cast("decimal(20,0)") - F.col("low") + 1 - F.col("numbers")
    most = F.lit((1 << 63) - 1).cast("decimal(20,0)")
    gaps = F.coalesce(F.least(wide, most), F.lit(0)).cast("bigint").alias("gaps")
    return Repaired(
        results,
        whole.select(*columns).unionByName(of_parts.select(*columns)),
        numbers.select("conv", gaps),
    )


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """One SHA-256 per conversation, whose pieces come in order; they are read and let go."""
    now, digest, begun = None, hashlib.sha256(), False
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv", "roles", "texts"))
        for conv, roles, texts in zip(*columns, strict=True):
            if conv != now:
                if now is not None:
                    yield now, digest.hexdigest()
                now, digest, begun = conv, hashlib.sha256(), False
            for role, text in zip(roles, texts, strict=True):
                digest.update(f"{chr(10) * begun}{role}:{text}".encode())
                begun = True
    if now is not None:
        yield now, digest.hexdigest()


def repaired_hashes(turns: DataFrame) -> DataFrame:
    """``(conv, repaired_sha256)`` of ``role:text`` by line, for ``Repaired.turns``.

    A hash of this kind is sequential, so a conversation of several pieces passes one task,
    piece by piece; no more than a batch of them is held.
    """
    lines = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    whole = turns.where("whole").select(
        "conv", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    )
    split = turns.where("not whole").repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return whole.unionByName(_mapped(split, _hashes, "conv string, repaired_sha256 string"))


def repair_digests(conversations: DataFrame) -> DataFrame:
    """Results of damaging and repairing ``conversations``, a row for each of their ids.

    ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``;
    see ``damaged`` and ``repair``. Null ids, roles and texts are one space, a null turn
    comes first. Empty texts are blank; texts count whole. Of repeated rows all but one are
    duplicates. A conversation that the damage leaves without turns has zeros, an empty
    audit and the hash of an empty string. An empty table gives no rows; other columns are
    not read.
    """
    given = plain_turns(conversations)
    fixed = repair(damaged(given))
    ids = conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")
    )
    found = fixed.results.join(fixed.gaps, "conv").join(repaired_hashes(fixed.turns), "conv")
    zero, none = F.lit(0).cast("bigint"), F.sha2(F.lit(""), 256)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, "conv", "left").select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", none).alias("repaired_sha256"),
    )
