import bisect
import hashlib
import json
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from given import TESTDATA
from tokenizers import Tokenizer

from shoptrail.llm import token_alignment
from shoptrail.llm.token_alignment import (
    BYTE_LEVEL,
    PIECES,
    align_tokens,
    alignment_counts,
    common_ends,
    groups_text,
)

COLUMNS = [
    "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
]
A = Tokenizer.from_file(BYTE_LEVEL)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def spelt(text):
    """Ids and bytes of both tokenizers' tokens, from their own decoders."""
    from tokenizers.decoders import ByteLevel

    letters = {}
    for b in range(256):
        plain = 33 <= b < 127 or 161 <= b < 173 or 174 <= b
        letters[chr(b) if plain else chr(256 + len([x for x in letters if ord(x) >= 256]))] = b
    assert ByteLevel().decode([next(c for c, b in letters.items() if b == 32)]) == " "
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    bytes_a = [bytes(letters[c] for c in A.id_to_token(i)) for i in a]
    bytes_b = [
        bytes([int(B.id_to_piece(i)[1:-1], 16)]) if B.is_byte(i)
        else B.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    return a, b, bytes_a, bytes_b


def plain_groups(text):
    """Groups as lists of ids, cut where the sets of end offsets meet."""
    if not text:
        return [], [], []
    a, b, bytes_a, bytes_b = spelt(text)
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return [], [], []

    def ends(parts):
        out, at = [], 0
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    at_a, at_b = ends(bytes_a), ends(bytes_b)
    cuts = sorted({*at_a} & {*at_b})
    groups = [([], []) for _ in cuts]
    for side, (ids, at) in enumerate(((a, at_a), (b, at_b))):
        for i, e in zip(ids, at):
            groups[bisect.bisect_left(cuts, e)][side].append(i)
    return a, b, groups


def plain_rows(rows):
    known = [(i, *plain_groups(t)) for i, t in rows]
    counts = Counter((g[0][-1], g[1][-1]) for *_, groups in known for g in groups)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for i, a, b, groups in known:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        yield (
            i, len(a), len(b), len(groups), len(links),
            sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        )


def found(docs, **kw):
    return sorted(map(tuple, alignment_counts(docs, **kw).select(*COLUMNS).collect()), key=repr)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1] or "") < 20_000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = sorted(plain_rows(rows), key=repr)
    assert found(docs) == expected
    # Counts that come by a join instead of a broadcast.
    assert found(docs, frequent=20) == expected


ODD = [
    (1, "a\tb\n\n c  <s> </s> <unk> <0x41> <|endoftext|>"), (1, "a b"), (1, "a b"), (2, None),
    (3, ""), (4, " "), (5, "has ▁ in it"), (None, "été 語 𝄞 ​ é"), (None, "a b"),
    (6, "x" * 30_000), (7, "word " * 20_000), (8, "\x00\x01\r\n"), (9, "  　 ﬁ Å"),
]


def test_odd_texts(spark):
    """Nulls, empty and very long texts, special tokens as text, marks, repeated rows."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    docs = docs.selectExpr("*", *[f"doc_id as `{c}`" for c in ("row", "pair", "times", "cnt", "b")])
    got = found(docs)
    assert got == sorted(plain_rows(ODD), key=repr)
    assert sum(r[-1] == "" for r in got) >= 3
    assert found(docs.limit(0)) == []


def test_groups_spell_the_same(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK", 10)
    docs = spark.createDataFrame(ODD[:9], "doc_id long, text string")
    for r in align_tokens(docs).collect():
        a, b = r["a_ids"], r["b_ids"]
        assert (len(r["a_ends"]) == 0) == (not a)
        if a:
            assert (r["a_ends"][-1], r["b_ends"][-1]) == (len(a), len(b))
            assert groups_text(a, b, r["a_ends"], r["b_ends"]).count(";") == len(r["a_ends"]) - 1


@pytest.mark.parametrize("seed", range(200))
def test_any_end_arrays(seed):
    draw = random.Random(seed)
    total = draw.choice([1, 2, 5, 50, 400])
    x, y = (
        sorted({*draw.sample(range(1, total + 1), draw.randint(0, total)), total}) for _ in "ab"
    )
    if seed % 3 == 0:  # nearly the same
        y = sorted({*x} ^ {*draw.sample(range(1, total + 1), min(2, total))} | {total})
    ends = sorted({*x} & {*y})
    assert common_ends(x, y) == ([x.index(e) + 1 for e in ends], [y.index(e) + 1 for e in ends])


def test_equal_stretches_take_few_probes():
    class Counted(list):
        probes = 0

        def __getitem__(self, at):
            Counted.probes += isinstance(at, slice)
            return super().__getitem__(at)

    n = 100_000
    ends = Counted(range(1, n + 1))
    assert common_ends(ends, list(ends))[0] == list(range(1, n + 1))
    assert Counted.probes < 40


class _SomeEmpty(np.ndarray):
    def all(self, *args, **kwargs):
        return False


@pytest.mark.parametrize("walked", [False, True])
def test_digests_of_a_chunk_are_those_of_its_texts(walked):
    made = token_alignment.Tokenizers(
        Path(token_alignment.BYTE_LEVEL).read_text(encoding="utf-8"),
        Path(token_alignment.PIECES).read_bytes(),
    )
    texts = ["", "one", "Une phrase, 3.14 fois", " ", "", "déjà vu 漢字 🙂", "one one one\n\tone", ""]
    if walked:  # as if a token had no bytes
        made.a_sizes = made.a_sizes.view(_SomeEmpty)
    sizes_a, sizes_b, groups, hashes, pairs, times = (
        c.to_pylist() for c in token_alignment._digests(made, texts)
    )
    for n, (a, b, a_ends, b_ends) in enumerate(made.align(texts)):
        assert (sizes_a[n], sizes_b[n], groups[n]) == (len(a), len(b), len(a_ends))
        spelt = groups_text(a, b, a_ends, b_ends)
        assert hashes[n] == (hashlib.sha256(spelt.encode()).hexdigest() if spelt else "")
        links = Counter(a[i - 1] << 32 | b[j - 1] for i, j in zip(a_ends, b_ends, strict=True))
        assert dict(zip(pairs[n], times[n], strict=True)) == links


def made_tokenizers():
    return token_alignment.Tokenizers(
        Path(BYTE_LEVEL).read_text(encoding="utf-8"), Path(PIECES).read_bytes()
    )


def digests(made, texts):
    columns = [c.to_pylist() for c in token_alignment._digests(made, texts)]
    return [(*r[:4], dict(zip(r[4], r[5], strict=True))) for r in zip(*columns, strict=True)]


def test_a_word_met_again_is_not_encoded_again():
    made, encode, met = made_tokenizers(), token_alignment.Tokenizers.encode, []

    def counted(texts):
        texts = list(texts)
        met.extend(texts)
        return encode(made, texts)

    made.encode = counted
    texts = ["some words, " * 5_000, "words, some " * 5_000 + "more"]
    got = digests(made, texts)
    assert sum(map(len, met)) < 200
    assert [r[:3] for r in got] == [
        (len(a), len(b), len(groups)) for a, b, groups in map(plain_groups, texts)
    ]


def test_words_give_what_whole_texts_give(monkeypatch):
    """Blanks of all kinds, marks and quotes beside spaces; words that are dropped again."""
    monkeypatch.setattr(token_alignment, "TOGETHER", 7)
    monkeypatch.setattr(token_alignment, "KEPT", 20_000)
    draw = random.Random(13)
    parts = [
        *" \n\t.,a1é漢🙂▁\x00\x1c\x85\xa0\u180e\u200b\u2028\u3000\u0301", "  ", " \n", "\r\n",
        "Bc", "don't", "'s", "23", "...", "<s>", "<|endoftext|>", " x", " y", " the", " 's", " of ",
        *" " * 9,
    ]
    by_word, whole = made_tokenizers(), made_tokenizers()
    whole.words.by_word = False
    assert by_word.words.by_word
    for _ in range(40):
        texts = ["".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(60)]
        assert digests(by_word, texts) == digests(whole, texts)


def test_tokenizers_whose_words_depend_on_each_other():
    from sentencepiece.sentencepiece_model_pb2 import ModelProto

    a, b = Path(BYTE_LEVEL).read_text(encoding="utf-8"), Path(PIECES).read_bytes()
    assert token_alignment.separable(a, b)
    pattern = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    token = {"id": 1, "content": "of the", "special": False}
    for change in (
        {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": pattern}, {"added_tokens": [token]},
        {"truncation": {"max_length": 5}}, {"pre_tokenizer": None},
    ):
        assert not token_alignment.separable(json.dumps(json.loads(a) | change), b)
    model = ModelProto.FromString(b)
    model.pieces[-1].piece = "of▁the"
    assert not token_alignment.separable(a, model.SerializeToString())
    model = ModelProto.FromString(b)
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    assert not token_alignment.separable(a, model.SerializeToString())
