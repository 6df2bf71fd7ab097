"""Every operator and stage on nulls, empty and long texts, repeats and clashing columns."""

import pytest

from shoptrail.llm.decontaminate import benchmark_copies, without_copies
from shoptrail.llm.language import accepted_documents, identify
from shoptrail.llm.line_dedup import dedup_lines
from shoptrail.llm.mixing import mix, mixed
from shoptrail.llm.pii import find_pii
from shoptrail.llm.quality_gam import quality_scores
from shoptrail.llm.quality_rules import judge
from shoptrail.llm.sharding import place
from shoptrail.llm.simhash import near_distinct, simhash_groups
from shoptrail.llm.token_counts import token_counts

PER_ROW = {
    "simhash": lambda docs, labels: simhash_groups(docs),
    "tokens": lambda docs, labels: token_counts(docs),
    "rules": lambda docs, labels: judge(docs),
    "shards": lambda docs, labels: place(docs),
    "pii": lambda docs, labels: find_pii(docs),
    "language": lambda docs, labels: identify(docs),
    "lines": lambda docs, labels: dedup_lines(docs),
    "classifier": quality_scores,
}
STAGES = {
    "language": lambda docs, items: accepted_documents(docs),
    "near copies": lambda docs, items: near_distinct(docs),
    "decontamination": without_copies,
    "mixing": lambda docs, items: mixed(docs),
}


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda i: (i is None, i or 0))


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(name, odd, some_labels):
    assert ids(PER_ROW[name](odd, some_labels)) == ids(odd)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_tables(name, odd, some_labels):
    assert PER_ROW[name](odd.limit(0), some_labels.limit(0)).collect() == []


def test_no_labels(odd, some_labels):
    scores = {r["score"] for r in quality_scores(odd, some_labels.limit(0)).collect()}
    assert scores == {0.5}


def test_no_languages(odd):
    found = identify(odd.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {(r["lang_pred"], r["score"], r["accepted"]) for r in found} == {("und", 0.0, False)}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns_and_whole_rows(name, odd, benchmark_items):
    kept = STAGES[name](odd, benchmark_items)
    assert kept.columns == odd.columns
    rows = {tuple(r) for r in odd.collect()}
    found = [tuple(r) for r in kept.collect()]
    assert found and set(found) <= rows


@pytest.mark.parametrize("name", STAGES)
def test_stages_on_empty_tables(name, odd, benchmark_items):
    assert STAGES[name](odd.limit(0), benchmark_items.limit(0)).collect() == []


def test_repeated_rows_and_missing_ids_are_near_copies(odd):
    kept = [r["doc_id"] for r in near_distinct(odd).collect()]
    assert kept.count(1) == 1 and 2 not in kept and kept.count(None) == 1


def test_copies_of_items_in_odd_texts(odd, benchmark_items):
    found = benchmark_copies(odd, benchmark_items)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(1, 1), (1, 1), (2, 1)]
    assert benchmark_copies(odd, benchmark_items.limit(0)).collect() == []


def test_mix_of_odd_texts(odd):
    rows = mix(odd).collect()
    assert sum(r["n"] for r in rows) == odd.count()
    assert all(0 <= r["copies"] <= 3 for r in rows)
    assert mix(odd.limit(0)).collect() == []


def test_batches_are_bounded(spark):
    from shoptrail.llm.batches import BATCH, bound_batches
    from shoptrail.session import settings

    rows, size = BATCH
    with settings(spark, {rows: 10_000, size: "64m"}):
        bound_batches(spark)
        assert (spark.conf.get(rows), spark.conf.get(size)) == ("1000", "16m")
        bound_batches(spark)
        assert (spark.conf.get(rows), spark.conf.get(size)) == ("1000", "16m")
        spark.conf.set(rows, 10)
        spark.conf.set(size, "8m")
        bound_batches(spark)
        assert (spark.conf.get(rows), spark.conf.get(size)) == ("10", "8m")
