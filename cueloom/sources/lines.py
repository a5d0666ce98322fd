"""Line-numbered text lists, the pipeline's interchange format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueloom.functions.text import fold_newlines
from cueloom.runtime import checkpointed

_SPLIT = ["file", "block"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, value)`` of a text list, numbered from 0.

    Blank lines count; a final newline starts no line. A list may be a folder of
    part files: numbering runs through them in name order. The files are read
    once: the lines are checkpointed with file, place of their split and row id, and
    everything else comes from that copy, so it does not matter how another read
    would split the files. A line's number is its rank in its split plus the lines
    of all earlier splits; the table of splits is summed up by ranges.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    lines = checkpointed(lines)
    splits = lines.groupBy(*_SPLIT).agg(F.count("*").alias("n"), F.min("row_id").alias("first_id"))
    ranged = checkpointed(splits.repartitionByRange(*_SPLIT).withColumn("range", F.spark_partition_id()))
    # Ranges are as many as partitions; splits are only ordered inside their range.
    sums = ranged.groupBy("range").agg(F.sum("n").alias("in_range"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("before_range"))
    inside = Window.partitionBy("range").orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, "range")
    starts = before.select(*_SPLIT, (F.col("before_range") + F.col("before") - F.col("first_id")).alias("shift"))
    return lines.join(starts, _SPLIT).select((F.col("row_id") + F.col("shift")).alias("line_no"), "value")


def write_pair_lists(
    pairs: DataFrame, out: str, languages: list[str], key: list[str], media: str, text: str
) -> None:
    """Write line-aligned lists ``media/language=<language>`` and ``transcription/language=<language>``.

    Both lists are written from one checkpointed order, task by task, so line *i*
    of one belongs to line *i* of the other in every language. Two writes make all
    languages. Line breaks inside a path or text become spaces. Lists of other
    languages stay.
    """
    ordered = checkpointed(
        pairs.where(F.col("language").isin(languages))
        .select("language", *key, *[fold_newlines(F.col(c)).alias(f"_{i}") for i, c in enumerate((media, text))])
        .orderBy("language", *key)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    # In the order of the checkpoint, ties included, however a task has to sort.
    ordered = ordered.sortWithinPartitions("language", "_row")
    for column, name in (("_0", "media"), ("_1", "transcription")):
        rows = ordered.select("language", F.coalesce(column, F.lit("")).alias("value"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("language").text(f"{out}/{name}")


def list_path(out: str, name: str, language: str) -> str:
    """Where ``write_pair_lists`` puts the list ``name`` of a language."""
    return f"{out}/{name}/language={language}"
