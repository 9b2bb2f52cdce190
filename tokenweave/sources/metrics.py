"""The metrics log as a sink and as a table.

Lines are ``"{step} {split} {loss:.4f}"``.  The sink truncates at the start of
a run (overwrite); afterwards a step's lines replace what was written for that
step, so a write that is tried again leaves them once.  The reader parses the space
separated fields back into ``(step BIGINT, split STRING, loss DOUBLE)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def metrics_lines(df: DataFrame, step: str = "step", split: str = "split",
                  loss: str = "loss") -> DataFrame:
    """One text line per evaluation, four decimals."""
    return df.select(F.col(step).cast("bigint").alias("step"),
                     F.format_string("%d %s %.4f", F.col(step).cast("bigint"), F.col(split),
                                     F.col(loss).cast("double")).alias("value"))


def write_metrics(lines: DataFrame, path: str, truncate: bool = False) -> str:
    """The lines of some steps, each step's folder replaced as a whole; ``truncate`` starts a new run."""
    (lines.select("step", "value").repartition("step")
     .write.mode("overwrite").option("partitionOverwriteMode", "static" if truncate else "dynamic")
     .partitionBy("step").text(path))
    return path


def parse_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The log as a table."""
    parts = F.split(F.trim(F.col("value")), " ")
    return (spark.read.text(path)
            .filter(F.length(F.trim(F.col("value"))) > 0)
            .select(parts.getItem(0).cast("bigint").alias("step"),
                    parts.getItem(1).alias("split"),
                    parts.getItem(2).cast("double").alias("loss")))


# Fixed value: the console line of a step.
STEP_LINE = "step %4d | loss: %.6f | tokens: %d"


def step_report(df: DataFrame, seconds: str | None = None) -> DataFrame:
    """The per-step console line, as data.

    ``seconds``, a column with a step's duration, adds the rate in tokens per
    second (Q7).  A duration differs from run to run, so the line is
    deterministic only without it.
    """
    parts = [F.col("step").cast("int"), F.col("loss").cast("double"), F.col("tokens").cast("bigint")]
    if seconds is None:
        return df.select("step", F.format_string(STEP_LINE, *parts).alias("line"))
    rate = F.col("tokens") / F.col(seconds)
    return df.select("step", F.format_string(STEP_LINE + " | tok/sec: %.2f", *parts, rate).alias("line"))
