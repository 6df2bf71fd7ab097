"""The four end-to-end jobs: files in, files out.

Results are written as text for other tools and, where another job reads them,
as Parquet too, so that the next job prunes columns and pushes filters down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoptrail.constants import (
    ALL_BEHAVIORS,
    DEEP_BEHAVIORS,
    KMEANS_K,
    KMEANS_MAX_ITER,
    KMEANS_SEED,
    KMEANS_TOL,
    TOP_ITEM_PAIRS,
    TOP_RECOMMENDATIONS,
    WALK_ALPHA,
    WALK_MAX_ITER,
    WALK_TOL,
)
from shoptrail.operators.clean import REJECTED, clean_behavior_log, records_and_rejects
from shoptrail.operators.clusters import kmeans_users
from shoptrail.operators.co_occurrence import item_co_occurrence
from shoptrail.operators.features import features_of_stats, user_features
from shoptrail.operators.index import item_user_index
from shoptrail.operators.pairs import deep_pairs, written_pairs
from shoptrail.operators.walk import personal_rank
from shoptrail.schemas import BEHAVIOR_LOG, REJECTED_LINES, USER_FEATURES
from shoptrail.session import settings
from shoptrail.sources import exports
from shoptrail.sources.durable import run_folder
from shoptrail.sources.stats_parts import read_stats, write_part
from shoptrail.sources.text_files import parse_feature_lines, read_lines

# Text per cleaning task: large, so that the files it writes are.
INPUT_SPLIT = "512m"


def read_log(
    spark: SparkSession,
    path: str,
    form: str = "text",
    valid: Sequence[str] = ALL_BEHAVIORS,
) -> DataFrame:
    """A behaviour log from ``text`` lines or the ``parquet`` table of clean records.

    Of the table only the folders of the ``valid`` behaviours are read.
    """
    if form == "parquet":
        log = spark.read.schema(BEHAVIOR_LOG).parquet(path).select(*BEHAVIOR_LOG.names)
        return log.where(F.col("behavior").isin(*valid))
    return clean_behavior_log(read_lines(spark, path), valid)


def write_clean_log(lines: DataFrame, path: str, keep_rejects: bool = False) -> dict[str, int]:
    """The table of clean records, a folder per behaviour; returns line counts.

    With ``keep_rejects`` the same pass writes the other lines, with the reason,
    to a folder of their own, which ``read_rejects`` reads.
    """
    seen = Observation()
    clean = records_and_rejects if keep_rejects else clean_behavior_log
    with settings(lines.sparkSession, {"spark.sql.files.maxPartitionBytes": INPUT_SPLIT}):
        exports.write_table(clean(lines, observation=seen), path, "behavior")
    return dict(seen.get)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``(line, reason)`` of the lines that ``write_clean_log`` kept as rejects."""
    table = spark.read.schema(REJECTED_LINES).parquet(path)
    return table.where(F.col("behavior") == REJECTED).select("line", "reason")


def add_log_part(
    spark: SparkSession, log_path: str, part: str, output_dir: str, form: str = "text"
) -> None:
    """Features of a log that grows: add one part of it, or write that part anew.

    Reads the new part and a row per user of each earlier one.
    """
    stats = f"{output_dir}/user_stats"
    write_part(read_log(spark, log_path, form), stats, part)
    features = features_of_stats(read_stats(spark, stats))
    exports.write_table(features, f"{output_dir}/user_features.parquet")


def clean_and_features(
    spark: SparkSession, input_path: str, output_dir: str, keep_rejects: bool = False
) -> dict[str, int]:
    """Clean a raw log and compute user features; returns line counts.

    The text is parsed once, into a table with a folder per behaviour; the rest
    reads that. Views are most of a log, and the jobs on deep interactions
    never open their folder. Every task reads ``INPUT_SPLIT`` of text, as it
    writes a file per behaviour.
    """
    table = f"{output_dir}/clean_behavior_log.parquet"
    counts = write_clean_log(read_lines(spark, input_path), table, keep_rejects)
    log = read_log(spark, table, "parquet")
    exports.write_lines(exports.log_lines(log), f"{output_dir}/clean_behavior_log.csv")
    exports.write_table(user_features(log), f"{output_dir}/user_features.parquet")
    features = spark.read.schema(USER_FEATURES).parquet(f"{output_dir}/user_features.parquet")
    exports.write_lines(exports.feature_lines(features), f"{output_dir}/user_features.csv")
    return counts


def index_and_co_occurrence(
    spark: SparkSession,
    log_path: str,
    output_dir: str,
    form: str = "text",
    top: int = TOP_ITEM_PAIRS,
) -> None:
    """Inverted index and the most frequent item pairs of a log."""
    with run_folder(spark):
        pairs = written_pairs(deep_pairs(read_log(spark, log_path, form, DEEP_BEHAVIORS)))
        exports.write_lines(
            exports.index_lines(item_user_index(pairs)),
            f"{output_dir}/item_user_inverted_index.txt",
        )
        exports.write_lines(
            exports.co_occurrence_lines(item_co_occurrence(pairs, top)),
            f"{output_dir}/item_co_occurrence.txt",
        )


def cluster_users(
    spark: SparkSession,
    features_path: str,
    output_dir: str,
    k: int = KMEANS_K,
    max_iter: int = KMEANS_MAX_ITER,
    tol: float = KMEANS_TOL,
    seed: int = KMEANS_SEED,
    form: str = "text",
) -> None:
    """K-Means labels and centres from a feature file."""
    if form == "parquet":
        features = spark.read.schema(USER_FEATURES).parquet(features_path)
    else:
        features = parse_feature_lines(read_lines(spark, features_path))
    with run_folder(spark):
        labels, centers = kmeans_users(features, k, max_iter, tol, seed)
        exports.write_lines(exports.label_lines(labels), f"{output_dir}/user_cluster_labels.csv")
        exports.write_lines(exports.center_lines(centers), f"{output_dir}/cluster_centers.txt")


def recommend(
    spark: SparkSession,
    log_path: str,
    target: str,
    output_dir: str,
    alpha: float = WALK_ALPHA,
    max_iter: int = WALK_MAX_ITER,
    tol: float = WALK_TOL,
    top: int = TOP_RECOMMENDATIONS,
    form: str = "text",
) -> None:
    """The target's top items it does not have yet, as one line."""
    pairs = deep_pairs(read_log(spark, log_path, form, DEEP_BEHAVIORS))
    with run_folder(spark):
        best = personal_rank(pairs, target, top, alpha=alpha, max_iter=max_iter, tol=tol)
        exports.write_lines(
            exports.recommendation_line(best, target),
            f"{output_dir}/personal_rank_recommendations.txt",
        )
