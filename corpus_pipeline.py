"""The corpus pipeline: documents in, a mixed, clean and sharded corpus out.

Every stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoptrail.llm.decontaminate import without_copies
from shoptrail.llm.language import accepted_documents
from shoptrail.llm.mixing import mixed
from shoptrail.llm.sharding import place
from shoptrail.llm.simhash import near_distinct
from shoptrail.sources.durable import durable


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the corpus names; others go."""
    return accepted_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id."""
    return near_distinct(docs)


def no_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_copies(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard they belong to."""
    return place(docs)


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", near_copies),
    ("decontamination", no_test_items),
    ("source_mixing", source_mix),
    ("sharding", shards),
]

# Trained models, fingerprints and hashed draws are nothing that SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage but the last is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
