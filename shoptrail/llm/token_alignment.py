"""Alignment of the tokens two tokenizers cut a text into.

Both token sequences spell the same bytes, so each is a rising array of end offsets. Most
of the way the tokens match one to one, and then both arrays are equal at a fixed shift of
their indexes. Probes of doubling length compare the arrays at the current shift and jump
such a stretch whole; where a probe fails, halves of it find the place. The group that
follows is irregular: it is walked token by token up to the next common end, which sets
the new shift.

Where neither tokenizer has a token across a space between two other characters, nor looks
across it, the tokens of a text are those of its words, and a group ends with each word.
A task then encodes each word it meets once, the new words of a chunk together, and keeps
its tokens' numbers, links and text of groups: a text is put together from those of its words.

How often two tokens end together is counted over the corpus: each text gives its distinct
pairs with their numbers. The most frequent pairs, a bounded number, come back to the texts
as a broadcast; rows of rarer pairs meet their counts in a join without hot keys.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.batches import as_bytes, documents, send
from shoptrail.sources.durable import durable

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # stands for a space in a piece
# Bytes of text that are tokenized at once; a longer text is alone.
CHUNK = 1 << 18
# A pair in more than this share of all rows of pairs is frequent, so at most as many are.
FREQUENT = 1 << 18
# New words that are encoded as one text.
TOGETHER = 200
# Bytes of words and of what is known of them; beyond these a task keeps the most used quarter.
KEPT = 1 << 26
# A space between two characters that are no blanks: all that ``separable`` asks for.
BETWEEN = re.compile(r" (?=\S)(?<=\S )")

ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"
_INTS = pa.list_(pa.int32())


def byte_letters() -> dict[str, int]:
    """The bytes behind the letters of a byte-level vocabulary.

    Bytes that print as a Latin-1 character stand for themselves, the others follow from
    code point 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def separable(byte_level: str, pieces: bytes) -> bool:
    """Whether the tokens of a text are those of its parts between ``BETWEEN``.

    So it is where A cuts texts by the pattern of byte-level BPE, which begins a part at such
    a space, and B merges pairs of an unchanged text into pieces that have marks for spaces
    only before other characters.
    """
    from sentencepiece.sentencepiece_model_pb2 import ModelProto

    a, b = json.loads(byte_level), ModelProto.FromString(pieces)
    cut, model, norm = a.get("pre_tokenizer") or {}, a["model"], b.normalizer_spec
    return (
        not any(a.get(k) for k in ("normalizer", "truncation", "padding"))
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space", True)
        and model.get("type") == "BPE"
        and not model.get("dropout")
        and all(token["special"] for token in a.get("added_tokens", ()))
        and b.trainer_spec.model_type == b.trainer_spec.BPE
        and not b.trainer_spec.treat_whitespace_as_suffix
        and norm.add_dummy_prefix
        and norm.escape_whitespaces
        and not norm.remove_extra_whitespaces
        and not norm.precompiled_charsmap
        and not any(
            p.type == p.USER_DEFINED or SPACE in p.piece.lstrip(SPACE) for p in b.pieces
        )
    )


class Tokenizers:
    """Both tokenizers, made in a task from the contents of their files."""

    def __init__(self, byte_level: str, pieces: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        letters = byte_letters()
        names = map(self.a.id_to_token, range(self.a.get_vocab_size()))
        self.a_bytes = [self._spelt(letters, name or "") for name in names]
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)])
            if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.a_sizes = np.array([len(t) for t in self.a_bytes])
        self.b_sizes = np.array([len(t) for t in self.b_bytes])
        # What a token adds to the text of its group, inside it and as the last of its side.
        self.written = [
            b"%d%b" % (i, end)
            for size, ends in ((len(self.a_bytes), b",|"), (len(self.b_bytes), b",;"))
            for i in range(size)
            for end in (ends[:1], ends[1:])
        ]
        # A token without bytes could be of either part.
        by_word = self.a_sizes.all() and self.b_sizes.all() and separable(byte_level, pieces)
        self.words = Words(self, bool(by_word))

    @staticmethod
    def _spelt(letters: dict[str, int], name: str) -> bytes:
        """The bytes of a token; one that is no byte-level text is as it is written."""
        known = all(c in letters for c in name)
        return bytes(letters[c] for c in name) if known else name.encode()

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Token ids of both for each text; none where either spells something else."""
        texts = list(texts)
        spaced = [" " + t for t in texts]
        encoded = self.a.encode_batch_fast(spaced, add_special_tokens=False)
        pieces = self.b.encode(texts, num_threads=1)
        for text, a, b in zip(spaced, (e.ids for e in encoded), pieces, strict=True):
            want = text.encode()
            same = (
                len(want) > 1
                and b"".join(map(self.a_bytes.__getitem__, a)) == want
                and b"".join(map(self.b_bytes.__getitem__, b)) == want
            )
            yield (a, b) if same else ([], [])

    def encode_words(self, words: list[str]) -> tuple[list[str], list[np.ndarray]]:
        """Words in the order they come out, and their ``(a, n_a, b, n_b)``.

        ``TOGETHER`` words are encoded as one text and cut where words end; where that text
        is spelt otherwise or a token goes across a word's end, words are left out.
        """
        runs = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        encoded = list(zip(runs, self.encode(map(" ".join, runs)), strict=True))
        joined = [word for run, (ids, _) in encoded if ids for word in run]
        ends = np.cumsum([len(w.encode()) + 1 for w in joined])
        found: list[np.ndarray] = []
        for side, sizes in enumerate((self.a_sizes, self.b_sizes)):
            ids, _ = _flat([both[side] for _, both in encoded])
            at = np.cumsum(sizes[ids])
            last = np.searchsorted(at, ends)
            if not np.array_equal(at[last], ends):
                return [], [np.zeros(0, np.int64)] * 4
            found += ids, np.diff(last + 1, prepend=0)
        return joined, found

    def align(self, texts: list[str]) -> Iterator[tuple[list[int], ...]]:
        """``(a_ids, b_ids, a_ends, b_ends)`` for each text."""
        for a, b in self.encode(texts):
            yield a, b, *common_ends(
                np.cumsum(self.a_sizes[a]).tolist() if a else [],
                np.cumsum(self.b_sizes[b]).tolist() if b else [],
            )


def common_ends(x: list[int], y: list[int]) -> tuple[list[int], list[int]]:
    """Where groups end: numbers of tokens on both sides up to each common end.

    ``x`` and ``y`` are rising end offsets whose last values are equal.
    """
    ends_x: list[int] = []
    ends_y: list[int] = []
    i = j = 0
    n, m = len(x), len(y)
    while i < n:
        # One to one at the shift j - i: probes of 1, 2, 4 ... and back.
        start, shift, step = i, j - i, 1
        while i + step <= n and j + step <= m and x[i : i + step] == y[j : j + step]:
            i += step
            j += step
            step *= 2
        while step > 1:
            step //= 2
            if i + step <= n and j + step <= m and x[i : i + step] == y[j : j + step]:
                i += step
                j += step
        if i > start:
            ends_x.extend(range(start + 1, i + 1))
            ends_y.extend(range(start + 1 + shift, j + 1))
        if i == n:
            break
        # An irregular group, up to the next common end.
        end_x, end_y = x[i], y[j]
        i += 1
        j += 1
        while end_x != end_y:
            if end_x < end_y:
                end_x = x[i]
                i += 1
            else:
                end_y = y[j]
                j += 1
        ends_x.append(i)
        ends_y.append(j)
    return ends_x, ends_y


def _chunks(texts: list[bytes | None]) -> Iterator[list[str]]:
    """Texts in groups of about ``CHUNK`` bytes; what is null or no UTF-8 is empty."""
    group: list[str] = []
    size = 0
    for t in texts:
        try:
            group.append((t or b"").decode())
        except UnicodeDecodeError:
            group.append("")
        size += len(t or b"")
        if size >= CHUNK:
            yield group
            group, size = [], 0
    if group:
        yield group


def align_tokens(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """``(doc_id, a_ids, b_ids, a_ends, b_ends)`` per row of ``docs``.

    ``byte_level`` (A) is a file of a byte-level tokenizer, which gets a space and the text;
    ``pieces`` (B) one of a sentencepiece model, which adds that space. The driver reads the
    files. Group k of a text has the tokens ``a_ids[a_ends[k-1]:a_ends[k]]`` and the same of
    B: the shortest runs that spell the same bytes.

    All arrays are empty for null and empty texts, and where the tokens of A or of B spell
    anything but a space and the text. Texts count whole, whatever their length. Repeated
    rows and rows without an id each get a row. Other columns are not read, so their names
    may be anything; an empty table gives no rows.
    """
    return _tokenized(docs, byte_level, pieces, ALIGNED, _arrays)


def _arrays(tokenizers: Tokenizers, texts: list[str]) -> list[pa.Array]:
    return [pa.array(c, _INTS) for c in zip(*tokenizers.align(texts), strict=True)]


def _tokenized(
    docs: DataFrame,
    byte_level: str,
    pieces: str,
    schema: str,
    columns: Callable[[Tokenizers, list[str]], list[pa.Array]],
) -> DataFrame:
    """``doc_id`` and what ``columns`` makes of the alignments of some texts."""
    files = Path(byte_level).read_text(encoding="utf-8"), Path(pieces).read_bytes()
    both = send(docs.sparkSession, (Tokenizers, *files))
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, *contents = both()
        tokenizers = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tokenizers = tokenizers or make(*contents)
            ids, at = batch.column("doc_id"), 0
            for group in _chunks(as_bytes(batch.column("text"))):
                made = columns(tokenizers, group)
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(group)), *made], names=names)
                at += len(group)

    return documents(docs).mapInArrow(run, schema)


def groups_text(a: list[int], b: list[int], a_ends: list[int], b_ends: list[int]) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group, in order."""
    left, right = list(map(str, a)), list(map(str, b))
    out, i, j = [], 0, 0
    for p, q in zip(a_ends, b_ends, strict=True):
        if p - i == 1 and q - j == 1:
            out.append(f"{left[i]}|{right[j]}")
        else:
            out.append(f"{','.join(left[i:p])}|{','.join(right[j:q])}")
        i, j = p, q
    return ";".join(out)


_DIGEST = (
    "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in one array, and how many are of each list."""
    sizes = np.array([len(ids) for ids in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, sizes.sum()), sizes


def _last_tokens(
    tokenizers: Tokenizers, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the last tokens of the groups in ``a`` and in ``b``, all texts in a row.

    Text k has ``n_a[k]`` and ``n_b[k]`` tokens. Both sides of each text spell the same
    bytes, so ends compare across texts.
    """
    x, y = tokenizers.a_sizes[a], tokenizers.b_sizes[b]
    if x.all() and y.all():
        x, y = np.cumsum(x), np.cumsum(y)
        at = np.searchsorted(y, x)
        last = np.flatnonzero(y[at] == x) if len(y) else at
        return last, at[last]
    # A token without bytes ends where the one before does; groups are walked then.
    last_a, last_b, i, j = [], [], 0, 0
    for p, q in zip(np.cumsum(n_a).tolist(), np.cumsum(n_b).tolist(), strict=True):
        ends = common_ends(np.cumsum(x[i:p]).tolist(), np.cumsum(y[j:q]).tolist())
        last_a.extend(i + n - 1 for n in ends[0])
        last_b.extend(j + n - 1 for n in ends[1])
        i, j = p, q
    return np.array(last_a, np.int64), np.array(last_b, np.int64)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Words:
    """What is known of the parts of texts that a task has met, a row for each.

    A part is a word with its space before it, or a whole text where ``by_word`` is not so.
    Rows without tokens are of parts that either tokenizer spells otherwise.
    """

    def __init__(self, tokenizers: Tokenizers, by_word: bool) -> None:
        self.tokenizers, self.by_word = tokenizers, by_word
        self.rows: dict[str, int] = {}
        self.spelt: list[bytes] = []  # the text of the groups
        self.n_a = self.n_b = self.used = self.links = np.zeros(0, np.int64)
        self.links_at = np.zeros(1, np.int64)  # of each row, and the end
        self.kept = 0

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the parts of all texts, and the number of parts of each text."""
        if self.kept > KEPT:
            self._shrink()
        parts = [(BETWEEN.split(t) if self.by_word else [t]) if t else [] for t in texts]
        rows, sizes = self._rows(parts), np.array([len(p) for p in parts], np.int64)
        # Whether a text is spelt the same is asked of it whole, where a part is not.
        odd = np.unique(np.repeat(np.arange(len(texts)), sizes)[self.n_a[rows] == 0])
        odd = odd[sizes[odd] > 1].tolist()
        if odd:
            for k in odd:
                parts[k] = [texts[k]]
            self._add([], list({texts[k] for k in odd}.difference(self.rows)))
            rows, sizes = self._rows(parts), np.array([len(p) for p in parts], np.int64)
        self.used += np.bincount(rows, minlength=len(self.used))
        return rows, sizes

    def _rows(self, parts: list[list[str]]) -> np.ndarray:
        every = list(chain.from_iterable(parts))
        together, alone = [], []
        for part in set(every).difference(self.rows):
            blank = part[0].isspace() or part[-1].isspace()
            (together if self.by_word and not blank else alone).append(part)
        if together or alone:
            self._add(together, alone)
        return np.fromiter(map(self.rows.__getitem__, every), np.int64, len(every))

    def _add(self, together: list[str], alone: list[str]) -> None:
        """Rows for new parts; those that have no blanks at their ends are encoded together."""
        parts, made = self.tokenizers.encode_words(together)
        if len(parts) < len(together):
            alone = alone + list(set(together).difference(parts))
        encoded = list(self.tokenizers.encode(alone))
        more = *_flat([r[0] for r in encoded]), *_flat([r[1] for r in encoded])
        a, n_a, b, n_b = (np.concatenate(x) for x in zip(made, more, strict=True))
        parts = parts + alone
        last_a, last_b = _last_tokens(self.tokenizers, a, n_a, b, n_b)
        groups = np.bincount(np.repeat(np.arange(len(n_a)), n_a)[last_a], minlength=len(n_a))
        spelt = _group_texts(self.tokenizers, a, b, last_a, last_b, n_a + n_b)
        links = a[last_a] * len(self.tokenizers.b_bytes) + b[last_b]
        self.rows.update(zip(parts, range(len(self.spelt), len(self.spelt) + len(parts))))
        self.spelt += spelt
        self.n_a, self.n_b = np.r_[self.n_a, n_a], np.r_[self.n_b, n_b]
        self.links_at = np.r_[self.links_at, self.links_at[-1] + np.cumsum(groups)]
        self.links = np.r_[self.links, links]
        self.used = np.r_[self.used, np.zeros(len(parts), np.int64)]
        self.kept += self._bytes(parts, spelt)

    @staticmethod
    def _bytes(parts: list[str], spelt: list[bytes]) -> int:
        """About what parts take; a row takes some 200 bytes besides."""
        return 200 * len(parts) + 4 * sum(map(len, parts)) + 4 * sum(map(len, spelt))

    def _shrink(self) -> None:
        """Keep the most used parts, up to a quarter of ``KEPT`` bytes."""
        parts = list(self.rows)
        order = np.argsort(-self.used, kind="stable")
        taken = np.cumsum([self._bytes([parts[k]], [self.spelt[k]]) for k in order.tolist()])
        keep = order[taken <= KEPT // 4]
        groups = np.diff(self.links_at)[keep]
        self.links = self.links[_ranges(self.links_at[keep], groups)]
        self.links_at = np.r_[0, np.cumsum(groups)]
        self.n_a, self.n_b = self.n_a[keep], self.n_b[keep]
        self.used = np.zeros(len(keep), np.int64)
        self.spelt = [self.spelt[k] for k in keep.tolist()]
        self.rows = {parts[k]: n for n, k in enumerate(keep.tolist())}
        self.kept = self._bytes(list(self.rows), self.spelt)


def _digests(tokenizers: Tokenizers, texts: list[str]) -> list[pa.Array]:
    """Sizes, hash of the groups, and distinct linked pairs ``a << 32 | b`` with their number.

    The texts of a chunk are worked on together, as an array of the rows of all their parts.
    """
    words = tokenizers.words
    rows, sizes = words.of(texts)
    text, ends = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes)
    groups = np.diff(words.links_at)[rows]

    def sums(counts: np.ndarray) -> pa.Array:
        return pa.array(np.diff(np.r_[0, np.cumsum(counts)][np.r_[0, ends]]), pa.int64())

    links = words.links[_ranges(words.links_at[rows], groups)]
    # Text, A id and B id as one number: texts of a chunk are fewer than its bytes.
    many_a, many_b = len(tokenizers.a_bytes), len(tokenizers.b_bytes)
    linked = np.repeat(text, groups) * (many_a * many_b) + links
    linked, times = np.unique(linked, return_counts=True)
    linked, id_b = np.divmod(linked, many_b)
    of_text, id_a = np.divmod(linked, many_a)
    offsets = pa.array(np.searchsorted(of_text, np.arange(len(texts) + 1)), pa.int32())
    spelt, at, hashes = [*map(words.spelt.__getitem__, rows.tolist())], 0, []
    for end in ends.tolist():
        groups_of = b";".join(spelt[at:end])
        hashes.append(hashlib.sha256(groups_of).hexdigest() if groups_of else "")
        at = end
    return [
        sums(words.n_a[rows]),
        sums(words.n_b[rows]),
        sums(groups),
        pa.array(hashes, pa.string()),
        pa.ListArray.from_arrays(offsets, pa.array(id_a << 32 | id_b)),
        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
    ]


def _group_texts(
    tokenizers: Tokenizers,
    a: np.ndarray,
    b: np.ndarray,
    last_a: np.ndarray,
    last_b: np.ndarray,
    sizes: np.ndarray,
) -> list[bytes]:
    """What ``groups_text`` gives for each text, which has ``sizes`` tokens.

    Tokens are put in the order in which the text of the groups has them.
    """
    ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    ends_a[last_a] = ends_b[last_b] = 1
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.r_[0, last_b + 1][group_a]] = 2 * a + ends_a
    order[np.arange(len(b)) + (last_a + 1)[group_b]] = 2 * (len(tokenizers.a_bytes) + b) + ends_b
    parts = list(map(tokenizers.written.__getitem__, order.tolist()))
    texts, at = [], 0
    for size in sizes.tolist():
        texts.append(b"".join(parts[at : at + size])[:-1])
        at += size
    return texts


def pair_counts(links: DataFrame) -> DataFrame:
    """``(pair, cnt, docs, best)``: links and texts of each pair, corpus-wide.

    ``links`` has a row per text and distinct ``pair``, with ``times``. ``best`` tells the
    pairs whose count no other pair of the same B id exceeds.
    """
    counted = durable(
        links.groupBy("pair").agg(
            F.sum("times").alias("cnt"), F.count(F.lit(1)).alias("docs")
        ),
        "pair-counts",
    ).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    # A row per B id: no more than the vocabulary has.
    most = counted.groupBy("b").agg(F.max("cnt").alias("most"))
    best = (F.col("cnt") == F.col("most")).alias("best")
    return durable(
        counted.join(F.broadcast(most), "b").select("pair", "cnt", "docs", best), "best-pairs"
    )


def alignment_counts(
    docs: DataFrame,
    byte_level: str = BYTE_LEVEL,
    pieces: str = PIECES,
    frequent: int = FREQUENT,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row.

    A link is a pair of tokens of A and B that end together. The count of a pair of ids is
    the number of its links in all rows; ``count_sum`` adds up the counts over the links of
    a text, ``n_best`` counts the links whose count is the highest of their B id, ties
    included. Without tokens (see ``align_tokens``) all numbers are 0 and the hash is ''.
    Repeated rows count repeatedly; an empty table gives no rows. ``frequent`` moves work
    between broadcast and join, never the result.
    """
    aligned = _tokenized(docs, byte_level, pieces, _DIGEST, _digests)
    rows = durable(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    zipped = F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))
    links = rows.select("row", F.inline(zipped).alias("pair", "times"))
    counted = pair_counts(links)
    total = counted.agg(F.sum("docs")).first()[0] or 0
    # Fewer than ``frequent`` pairs can have more than that share of the rows.
    often = F.col("docs") * frequent > F.lit(total)
    known = F.broadcast(counted.where(often).select("pair", "cnt", "best"))
    rare = counted.where(~often).select("pair", "cnt", "best")
    by_text = _sums(links.join(known, "pair"))
    if not rare.isEmpty():
        others = links.join(known.select("pair"), "pair", "left_anti").join(rare, "pair")
        by_text = by_text.unionByName(_sums(others))
    sums = by_text.groupBy("row").agg(
        *[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")]
    )
    zero = F.lit(0).cast("bigint")
    return rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").join(
        sums, "row", "left"
    ).select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        *[F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")],
        "groups_sha256",
    )


def _sums(links: DataFrame) -> DataFrame:
    """Per text; its rows are still together, so they add up before any shuffle."""
    return links.groupBy("row").agg(
        F.sum(F.col("times").cast("bigint")).alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0).cast("bigint")).alias("n_best"),
        F.sum(F.col("times") * F.col("cnt")).alias("count_sum"),
    )
