"""Every registered query against its SQL, on the smallest tables."""

import importlib
from pathlib import Path

import duckdb
import pytest
from given import TESTDATA

entry_point = importlib.import_module("__spark_entry__")
QUERIES = entry_point.queries()
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in Path(TESTDATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    yield con
    con.close()


# The training-data operators have tests of their own.
OWN = sorted(n for n in QUERIES if n != "pipeline" and not n.startswith("op"))


def test_each_query_has_sql():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["user_id", "f1", "f2", "f3"]
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query(spark, tables, name):
    found = QUERIES[name](spark, TESTDATA)
    columns = sorted(found.columns)
    cursor = tables.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    rows = [tuple(row) for row in found.select(*columns).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))
    assert rows
