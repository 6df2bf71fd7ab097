"""Raw log lines to valid typed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shoptrail.constants import ALL_BEHAVIORS, LOG_FIELDS, LOG_HEADER_PREFIX
from shoptrail.functions.text import as_long, strip

_FIELDS = ("user_id", "item_id", "category_id", "behavior", "ts_text")


def judge_lines(
    lines: DataFrame, valid: Sequence[str] = ALL_BEHAVIORS, fold_case: bool = False
) -> DataFrame:
    """Fields of each line, and ``reason`` why it is no record (null if it is).

    Any line that starts with the header word is a header, even one whose
    first field only begins with it. Fields after the fifth are ignored.
    """
    split = lines.select(strip(F.col("value")).alias("line")).select(
        "line", F.split("line", ",", -1).alias("parts")
    )
    fields = split.select(
        "line",
        F.size("parts").alias("field_count"),
        *[strip(F.get("parts", i)).alias(name) for i, name in enumerate(_FIELDS)],
    )
    if fold_case:
        fields = fields.withColumn("behavior", F.lower("behavior"))
    blank = F.lit(False)
    for name in _FIELDS:
        blank = blank | (F.col(name) == "")
    reason = (
        F.when(F.col("line").isNull() | (F.col("line") == ""), "empty line")
        .when(F.lower("line").startswith(LOG_HEADER_PREFIX), "header")
        .when(F.col("field_count") < LOG_FIELDS, "too few fields")
        .when(blank, "blank field")
        .when(~F.col("behavior").isin(*valid), "unknown behavior")
        .when(F.col("ts").isNull(), "bad timestamp")
    )
    return fields.withColumn("ts", as_long(F.col("ts_text"))).withColumn("reason", reason)


def clean_behavior_log(
    lines: DataFrame,
    valid: Sequence[str] = ALL_BEHAVIORS,
    fold_case: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Valid records of ``lines`` (one string column ``value``).

    Stateless, one narrow pass; also works on a streaming input. An
    ``observation`` receives the counts ``lines`` and ``kept`` of whichever
    action runs the result, without a second pass.
    """
    judged = judge_lines(lines, valid, fold_case)
    kept = F.col("reason").isNull()
    if observation is not None:
        judged = judged.observe(
            observation,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(kept).alias("kept"),
        )
    # A filter would be pushed below the projection and split every line a
    # second time; unnesting zero or one record per line splits it once.
    record = F.struct("user_id", "item_id", "category_id", "behavior", "ts")
    return judged.select(F.inline(F.when(kept, F.array(record))))


# The folder of rejected lines, beside those of the behaviours.
REJECTED = "rejected"


def records_and_rejects(
    lines: DataFrame,
    valid: Sequence[str] = ALL_BEHAVIORS,
    fold_case: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Every line, as a record or with the reason why it is none.

    The columns of a record, then ``line`` and ``reason``. A record has neither
    of these; a rejected line has only these and the behaviour ``REJECTED``.
    Written with a folder per behaviour, records and rejects come from one pass,
    and who reads the records never opens the rejects.
    """
    if REJECTED in valid:
        raise ValueError(f"{REJECTED!r} names rejected lines and can be no behaviour")
    judged = judge_lines(lines, valid, fold_case)
    kept = F.col("reason").isNull()
    if observation is not None:
        judged = judged.observe(
            observation, F.count(F.lit(1)).alias("lines"), F.count_if(kept).alias("kept")
        )
    return judged.select(
        *[F.when(kept, F.col(c)).alias(c) for c in ("user_id", "item_id", "category_id")],
        F.when(kept, F.col("behavior")).otherwise(F.lit(REJECTED)).alias("behavior"),
        F.when(kept, F.col("ts")).alias("ts"),
        F.when(~kept, F.col("line")).alias("line"),
        "reason",
    )


def line_verdicts(lines: DataFrame, valid: Sequence[str] = ALL_BEHAVIORS) -> DataFrame:
    """Number of lines per reject reason; valid lines count as ``kept``."""
    return (
        judge_lines(lines, valid)
        .groupBy(F.coalesce("reason", F.lit("kept")).alias("verdict"))
        .agg(F.count(F.lit(1)).alias("line_count"))
    )
