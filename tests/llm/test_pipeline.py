"""The pipeline on the smallest tables, against the stages done the plain way."""

import importlib
from collections import Counter

import numpy as np
from given import TESTDATA
from test_simhash import components, plain_fingerprint, unsigned

from shoptrail.llm.decontaminate import MATCH, MIN_SCORE, Items, align, words
from shoptrail.llm.language import identify
from shoptrail.llm.mixing import mix
from shoptrail.llm.sharding import SHARDS, SLOTS, shard_table

pipeline = importlib.import_module("corpus_pipeline")


def first_of_groups(texts):
    """Least ids of near copies, by comparing all fingerprints."""
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints.values()}
    roots = components(sorted(set(signed.values())), 4)
    least = {}
    for d in sorted(prints):
        least.setdefault(roots[signed[prints[d]]], d)
    assert all(unsigned(signed[p]) == p for p in signed)
    return set(least.values())


def copies_an_item(text, items):
    """Whether the whole text aligned with each whole item gives a copy."""
    numbers = items.numbers(words((text or "").encode()))
    if not len(numbers):
        return False
    longest = max(map(len, items.words))
    padded = np.array([np.pad(w, (0, longest - len(w)), constant_values=-1) for w in items.words])
    score = align(padded, np.tile(numbers, (len(padded), 1)))[0]
    return any(s / (MATCH * len(w)) >= MIN_SCORE for s, w in zip(score, items.words, strict=True))


def test_against_plain_stages(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = {r["doc_id"] for r in identify(docs).collect() if r["accepted"]}
    kept = first_of_groups({d: text[d] or "" for d in known})
    rows = spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()
    items = Items([(r["item_id"], r["text"].encode()) for r in rows], 3)
    clean = {d for d in kept if not copies_an_item(text[d], items)}
    assert len(clean) < len(kept) < len(known)

    left = docs.where(docs["doc_id"].isin(sorted(clean)))
    copies = {r["doc_id"]: r["copies"] for r in mix(left).collect() if r["copies"]}
    found = pipeline.run(spark, TESTDATA).collect()
    assert Counter(r["doc_id"] for r in found) == copies
    table = shard_table(SHARDS)
    assert all(r["text"] == text[r["doc_id"]] for r in found)
    assert all(0 <= r["slot"] < SLOTS and r["shard"] == SHARDS[table[r["slot"]]] for r in found)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, TESTDATA).columns == docs.columns
    assert [name for name, _ in pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "decontamination", "source_mixing", "sharding",
    ]
