"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.llm.conversations import repair_digests
from shoptrail.llm.decontaminate import benchmark_copies
from shoptrail.llm.language import identify
from shoptrail.llm.line_dedup import dedup_lines
from shoptrail.llm.mixing import mix
from shoptrail.llm.pii import find_pii
from shoptrail.llm.quality_gam import quality_scores
from shoptrail.llm.quality_rules import judge
from shoptrail.llm.sharding import place
from shoptrail.llm.simhash import simhash_groups
from shoptrail.llm.token_alignment import alignment_counts
from shoptrail.llm.token_counts import token_counts
from shoptrail.llm.toxicity import toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _mixed_sizes(docs: DataFrame) -> DataFrame:
    """A row per document with the words the mix takes."""
    row = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("row")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken, row).drop("row")


def _line_digests(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


# Lines by document: blanks off both ends, A to Z in lower case.
_LINE_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed
  WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN firsts USING (key)
GROUP BY doc_id
"""


def queries() -> dict[str, Query]:
    return {
        "op1_simhash_near_dedup": lambda spark, sf_dir: simhash_groups(
            _documents(spark, sf_dir)
        ),
        "op2_token_counts": lambda spark, sf_dir: token_counts(_documents(spark, sf_dir)),
        "op3_quality_rules": lambda spark, sf_dir: judge(_documents(spark, sf_dir)),
        "op4_source_mixing": lambda spark, sf_dir: _mixed_sizes(_documents(spark, sf_dir)),
        "op5_sharding": lambda spark, sf_dir: place(_documents(spark, sf_dir)).select(
            "doc_id", "slot", "shard"
        ),
        "op6_pii": lambda spark, sf_dir: find_pii(_documents(spark, sf_dir)),
        "op7_language_id": lambda spark, sf_dir: identify(_documents(spark, sf_dir)),
        "op8_line_dedup": lambda spark, sf_dir: _line_digests(_documents(spark, sf_dir)),
        "op9_decontamination": lambda spark, sf_dir: benchmark_copies(
            _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
        ),
        "op10_quality_classifier": lambda spark, sf_dir: quality_scores(
            _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
        ),
        "op11_toxicity": lambda spark, sf_dir: toxicity_scores(
            _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
        ),
        "op12_conversation_repair": lambda spark, sf_dir: repair_digests(
            spark.read.parquet(f"{sf_dir}/conversations.parquet")
        ),
        "op13_token_alignment": lambda spark, sf_dir: alignment_counts(
            _documents(spark, sf_dir)
        ),
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_line_dedup": _LINE_SQL}
