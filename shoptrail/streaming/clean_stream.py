"""Clean log files as they arrive."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoptrail.operators.clean import clean_behavior_log


def clean_arrivals(
    spark: SparkSession, input_dir: str, output_dir: str, progress_dir: str
) -> StreamingQuery:
    """Append the valid records of all new files, then stop.

    The same stateless cleaning as the batch job, into the same layout with a
    folder per behaviour. ``progress_dir`` remembers which files are done, so a
    restart neither skips nor repeats one.
    """
    lines = spark.readStream.text(input_dir)
    return (
        clean_behavior_log(lines)
        .writeStream.format("parquet")
        .partitionBy("behavior")
        .option("path", output_dir)
        .option("checkpointLocation", progress_dir)
        .trigger(availableNow=True)
        .start()
    )
