"""Small helpers around Arrow batches of documents."""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Exactly what bytes.split() splits at.
BLANKS = "\x20\t\n\x0b\x0c\r"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Texts in one Arrow batch, and its bytes. Spark's own 10,000 rows and 64 MB take,
# with the copies that are made on the way, some hundreds of MB a task.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": (1000, "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": (16 << 20, "16m"),
}


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limits of Arrow batches to ``BATCH``, where they are higher.

    They are settings of the session and read when a query runs, so they stay.
    """
    for key, (most, value) in BATCH.items():
        now = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(key).lower())
        size = int(now[1]) << " kmg".index(now[2] or " ") * 10 if now else 0
        if not 0 < size <= most:
            spark.conf.set(key, value)


def send(spark: SparkSession, value: object) -> Callable[[], object]:
    """A broadcast of ``value``: what is returned gives it, in tasks.

    Its classes travel with it, so executors need no copy of this package.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    held: list[object] = []

    def get() -> object:
        if not held:  # once per task
            held.append(pickle.loads(packed.value))
        return held[0]

    return get


def documents(docs: DataFrame, *more) -> DataFrame:
    """``doc_id`` and ``text`` alone, with ``more`` columns; whatever else ``docs`` has."""
    bound_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"), *more
    )


def text_key() -> Column:
    """A hash of the text, which with the id tells the rows of a table apart."""
    return F.xxhash64(F.col("text").cast("string"))


def id_or_last() -> Column:
    """``doc_id`` as joins and sorts take it: no id comes after all ids."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))


def keyed(docs: DataFrame, **more: Column) -> DataFrame:
    """Whole rows as ``row``, whatever their columns, with ``id`` and ``text_key``."""
    named = [c.alias(name) for name, c in more.items()]
    return docs.select(
        F.struct("*").alias("row"), id_or_last().alias("id"), text_key().alias("text_key"), *named
    )


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def per_text(df: DataFrame, rows: Callable[[bytes], tuple], schema: str) -> DataFrame:
    """The columns of ``df`` before ``text``, then what ``rows`` gives for each text.

    ``rows`` gets the UTF-8 bytes of a text (null: empty) and returns the values
    of the columns of ``schema`` that follow. Spark bounds a batch by its bytes.
    """
    kept = [c for c in df.columns if c != "text"]
    before = ", ".join(f"{name} {kind}" for name, kind in df.select(*kept).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [rows(t or b"") for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)],
                names=kept + names,
            )

    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [_KINDS[part.split()[1]] for part in schema.split(", ")]
    return df.mapInArrow(run, f"{before}, {schema}")


_KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
}
