"""Choosing among training checkpoints from a table ``(run, step, wer)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cueloom.constants import KEPT_CHECKPOINTS


def best_checkpoint(metrics: DataFrame) -> DataFrame:
    """``(run, step, wer)`` with the lowest error of each run; the earlier step on a tie."""
    best = metrics.where(F.col("wer").isNotNull()).groupBy("run").agg(F.min(F.struct("wer", "step")).alias("best"))
    return best.select("run", "best.step", "best.wer")


def retained_checkpoints(metrics: DataFrame, limit: int = KEPT_CHECKPOINTS) -> DataFrame:
    """The newest ``limit`` checkpoints of each run, the best always among them.

    The ranking filter lets Spark keep only ``limit`` rows per run and map task
    before the shuffle, so a run of any length is cheap.
    """
    newest = Window.partitionBy("run").orderBy(F.desc("step"))
    recent = metrics.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= limit)
    best = best_checkpoint(metrics)
    others = (
        recent.drop("_age")
        .join(best.select("run", "step"), ["run", "step"], "left_anti")
        .withColumn("_age", F.row_number().over(newest))
        .where(F.col("_age") < limit)
    )
    flagged = best.withColumn("is_best", F.lit(True))
    return flagged.unionByName(others.drop("_age").withColumn("is_best", F.lit(False)))
