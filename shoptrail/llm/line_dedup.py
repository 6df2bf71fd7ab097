"""Lines that repeat across documents: each stays in one document only.

Lines are 128-bit hashes, range-partitioned with a secondary sort by document
and position. The first document of a hash streams by first, and later ones
lose the line. What comes back per document is a bitmap of its kept lines, as
runs, and no text moves until it is applied.

A line that a third of all documents share would fill one partition. A bounded
sketch names all lines that may be that frequent; their first documents are
plain minima that combine before the shuffle, and their rows never move.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.batches import BLANKS, documents, id_or_last, text_key
from shoptrail.sources.durable import durable

MIN_CHARS = 10
# The sketch finds every line with more than about a 3,750th of all rows.
TRACKED = 10_000


def _lower(c: Column) -> Column:
    """``c`` with A to Z in lower case, and no other letter changed."""
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, ascii_uppercase, ascii_lowercase))


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``(id, text_key, pos, h1, h2)`` of the lines that may be dropped."""
    each = docs.select("id", "text_key", F.posexplode(_split(F.col("text"))).alias("pos", "line"))
    key = F.btrim("line", F.lit(BLANKS))
    long_enough = each.select("id", "text_key", "pos", key.alias("key")).where(
        F.length("key") >= min_chars
    )
    key = _lower(F.col("key"))
    return long_enough.select(
        "id", "text_key", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")
    )


def _may_be_hot(lines: DataFrame) -> DataFrame:
    """A bounded number of hashes, with all that a large part of the rows have."""
    top = lines.agg(
        F.call_function("approx_top_k", "h1", F.lit(TRACKED // 10), F.lit(TRACKED)).alias("top")
    ).select(F.explode("top").alias("t"))
    return top.where(F.col("t.count") > 1).select(F.col("t.item").alias("h1"))


def _dropped(lines: DataFrame) -> DataFrame:
    """Lines whose hash has an earlier document."""
    hot = F.broadcast(durable(_may_be_hot(lines), "hot-lines"))
    hot_lines = lines.join(hot, "h1", "left_semi")
    firsts = hot_lines.groupBy("h1", "h2").agg(
        F.min("id").alias("first"), F.max("id").alias("last")
    )
    firsts = firsts.where(F.col("first") < F.col("last")).drop("last")
    late_hot = hot_lines.join(F.broadcast(firsts), ["h1", "h2"]).where(F.col("id") != F.col("first"))

    cold = lines.join(hot, "h1", "left_anti")
    ranged = cold.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", "id", "pos")
    earlier = Window.partitionBy("h1", "h2").orderBy("id", "pos")
    late = ranged.withColumn("first", F.first("id").over(earlier)).where(
        F.col("id") != F.col("first")
    )
    columns = ("id", "text_key", "pos")
    return late.select(*columns).unionByName(late_hot.select(*columns))


def _runs(dropped: Column, n_lines: Column) -> Column:
    """Runs of kept lines between sorted ``dropped`` positions: ``(start, n)``, from 1."""
    ends = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines))
    runs = F.transform(
        F.sequence(F.lit(0), F.size(dropped)),
        lambda i: F.struct(
            (F.get(ends, i) + 2).alias("start"),
            (F.get(ends, i + 1) - F.get(ends, i) - 1).alias("n"),
        ),
    )
    return F.filter(runs, lambda run: run["n"] > 0)


def _keyed(docs: DataFrame) -> DataFrame:
    return documents(docs).select(
        id_or_last().alias("id"), text_key().alias("text_key"), "doc_id", "text"
    )


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(id, text_key, dropped)``: sorted positions, for documents that lose a line."""
    lines = durable(_lines(_keyed(docs), min_chars), "lines")
    return (
        _dropped(lines)
        .groupBy("id", "text_key")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row of ``docs``: ``(doc_id, n_lines, n_dropped, kept_runs, text)``.

    Lines are compared without blanks at both ends and with A to Z in lower
    case. A line of at least ``min_chars`` characters that several documents
    have is dropped everywhere but in the one with the least ``doc_id``, where
    all its occurrences stay. ``kept_runs`` is the bitmap of kept lines as runs
    ``(start, n)``, and ``text`` the kept lines. A null or empty text is one
    empty line; a document that loses every line has an empty text. Repeated
    rows of a ``doc_id`` are the same document; rows without one count as one
    document after all others. Other columns of ``docs`` are ignored.
    """
    none = F.array().cast("array<int>")
    rows = (
        _keyed(docs)
        .join(dropped_lines(docs, min_chars), ["id", "text_key"], "left")
        .select(
            "doc_id",
            _split(F.col("text")).alias("lines"),
            F.coalesce("dropped", none).alias("dropped"),
        )
        .select(
            "doc_id", "lines", "dropped", _runs(F.col("dropped"), F.size("lines")).alias("kept_runs")
        )
    )
    kept = F.flatten(
        F.transform("kept_runs", lambda run: F.slice("lines", run["start"], run["n"]))
    )
    return rows.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size("dropped").cast("bigint").alias("n_dropped"),
        "kept_runs",
        F.array_join(kept, "\n").alias("text"),
    )
