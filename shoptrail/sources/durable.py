"""Intermediate results that outlive executors.

A multi-pass job writes what it reads again as a Parquet table below the
folder named by ``spark.checkpoint.dir``. That cuts the lineage, gives the
planner real sizes, and leaves nothing on an executor that could be lost.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_MARK = "_shoptrail_durable"
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session, or in local mode a scratch folder for its time."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="shoptrail-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody uses yet, in the folder of the current run if there is one."""
    return f"{_run_folder.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[None]:
    """Give the tables written inside a folder of their own, deleted at the end.

    For work that writes its results before it ends. DataFrames that leave the
    block must not read tables written in it. Deleting takes a classic session,
    whose driver reaches the file system.
    """
    path = new_path(spark, "run")
    token = _run_folder.set(path)
    try:
        yield
    finally:
        _run_folder.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(hadoop, True)


def mark_durable(df: DataFrame) -> DataFrame:
    """Note that ``df`` is a plain table scan, so it need not be written again."""
    setattr(df, _MARK, True)
    return df


def durable(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    if getattr(df, _MARK, False):
        return df
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return mark_durable(spark.read.schema(df.schema).parquet(path))
