"""The registered queries over whole small tables: columns, rows and plain recomputation."""

import hashlib
import zlib
from pathlib import Path

import duckdb
import pytest
from given import TESTDATA
from test_pii import KINDS, plain, shown
from test_quality import plain_repeats
from test_simhash import components, plain_fingerprint
from test_token_counts import plain as plain_tokens

from shoptrail.llm.queries import oracle_sql, queries
from shoptrail.llm.sharding import SHARDS, shard_table
from shoptrail.llm.token_counts import piece_scores

COLUMNS = {
    "op1_simhash_near_dedup": "doc_id bigint, fingerprint string, component_id bigint",
    "op2_token_counts": "doc_id bigint, n_words bigint, n_tokens bigint",
    "op3_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op4_source_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op5_sharding": "doc_id bigint, slot int, shard string",
    "op6_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string",
    "op7_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op8_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op9_decontamination": "doc_id bigint, item_id bigint, score double",
    "op10_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op11_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op13_token_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, "
    "n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
}


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()
    return {r["doc_id"]: r for r in rows}


@pytest.fixture(scope="module")
def found(spark):
    made = {}

    def get(name):
        if name not in made:
            df = queries()[name](spark, TESTDATA)
            made[name] = dict(df.dtypes), df.collect()
        return made[name]

    return get


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(found, documents, name):
    kinds, rows = found(name)
    for column in COLUMNS[name].split(", "):
        column, kind = column.split(" ")
        assert kinds[column] == kind
        assert all(r[column] is not None for r in rows)
    if name != "op9_decontamination":
        assert sorted(r["doc_id"] for r in rows) == sorted(documents)


def test_names():
    # Rows of op12 are conversations, which test_conversations.py covers.
    assert set(queries()) == {*COLUMNS, "op12_conversation_repair"}


def test_fingerprints_and_components(found, documents):
    rows = found("op1_simhash_near_dedup")[1]
    prints = {d: plain_fingerprint(r["text"] or "") for d, r in documents.items()}
    signed = {d: p - (1 << 64) if p >> 63 else p for d, p in prints.items()}
    roots = components(sorted(set(signed.values())), 4)
    least = {}
    for d in sorted(signed):
        least.setdefault(roots[signed[d]], d)
    for r in rows:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == least[roots[signed[r["doc_id"]]]]


def test_token_counts(found, documents):
    scores = piece_scores()
    for r in found("op2_token_counts")[1][:25]:
        words = (documents[r["doc_id"]]["text"] or "").encode().split()
        expected = sum(plain_tokens(w.decode(), scores) for w in words)
        assert (r["n_words"], r["n_tokens"]) == (len(words), expected)


def test_rule_counts(found, documents):
    for r in found("op3_quality_rules")[1]:
        text = documents[r["doc_id"]]["text"] or ""
        words = [w.decode() for w in text.encode().split()]
        assert r["n_words"] == len(words)
        assert r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == plain_repeats(words)
        failed = len(words) < 50 or 100 * r["n_repeat_words"] > 50 * len(words)
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_mixed_words(found, documents):
    rows = found("op4_source_mixing")[1]
    for source in {r["source"] for r in documents.values()}:
        own = [r for r in rows if documents[r["doc_id"]]["source"] == source]
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        off = abs(sum(r["taken"] for r in own) - own[0]["target"])
        assert off <= max(r["size"] for r in own) / 2 + 1e-6
        assert all(r["taken"] <= 3 * r["size"] for r in own)


def test_shards(found):
    table = shard_table(SHARDS)
    assert all(r["shard"] == SHARDS[table[r["slot"]]] for r in found("op5_sharding")[1])


def test_personal_data(found, documents):
    for r in found("op6_pii")[1]:
        base = plain(documents[r["doc_id"]]["text"] or "")
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(shown(base).encode()).hexdigest()
        assert set(filter(None, shown(base).split(","))) <= set(r["spans"].split(","))


def test_languages(found, documents):
    held = [r for r in found("op7_language_id")[1] if r["held_out"]]
    assert {r["doc_id"] for r in held} == {
        d for d in documents if zlib.crc32(str(d).encode()) % 3 == 1
    }
    right = [r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held]
    assert sum(right) >= 0.97 * len(right)


def test_lines_equal_the_sql(found):
    con = duckdb.connect()
    for f in Path(TESTDATA).glob("documents.parquet"):
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{f}'")
    rows = con.execute(oracle_sql()["op8_line_dedup"]).fetchall()
    assert sorted(rows) == sorted(map(tuple, found("op8_line_dedup")[1]))


def test_quality(found, documents, spark):
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet").collect()
    quality = {r["doc_id"]: r["quality"] for r in labels}
    rows = found("op10_quality_classifier")[1]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    right = [r["predicted"] == quality[r["doc_id"]] for r in rows if r["doc_id"] in quality]
    assert sum(right) >= 0.95 * len(right)
