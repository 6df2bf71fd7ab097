import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, partitions=3):
        """Rows of (doc_id, text[, lang[, source]])."""
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, an empty and a very long text, ties, repeated rows, clashing columns."""
    rows = [
        (1, "a b c d e f. Plain words of a small text", "en", "s1"),
        (1, "a b c d e f. Plain words of a small text", "en", "s1"),
        (2, "a b c d e f. Plain words of a small text", "en", None),
        (None, "A text without an id\nand with two lines", None, "s1"),
        (None, "A text without an id\nand with two lines", None, "s1"),
        (3, None, "en", "s2"),
        (4, "", "fr", None),
        (5, " \n\t\r\n ", None, None),
        (6, "word " * 40_000, "en", "s2"),
        (7, "x" * 150_000, "fr", "s2"),
        (8, "été Ünïcode 語 +1 (269) 555-3296 a@b.co 1.2.3.4", "fr", ""),
        (-9, "one", "en", "s1"),
    ]
    clashing = [
        "row", "id", "text_key", "fingerprint", "component_id", "size", "n", "copies", "copy",
        "from", "target", "slot", "block", "class", "score", "pattern", "first", "dropped", "lines",
        "features", "quality", "training", "length", "letters", "flat", "spans", "kept", "p",
    ]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    extra = [f"doc_id as `{c}`" for c in clashing]
    return made.selectExpr("*", *extra).repartition(3)


@pytest.fixture(scope="session")
def benchmark_items(spark):
    return spark.createDataFrame(
        [(1, "Plain words of a small text"), (None, "no id here at all"), (2, None), (3, "a"), (4, "")],
        "item_id long, text string",
    )


@pytest.fixture(scope="session")
def some_labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 1, None), (4, 0, 0), (6, None, 1), (None, 1, 1), (7, 5, 0), (8, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
