"""Language-partitioned datasets, clips and result sheets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Blanks at the ends of a text are part of it.
_SHEET = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _by_language(rows: DataFrame) -> DataFrame:
    """Rows of a language together, in tasks of even size.

    Without it every task writes a file per language. A rebalance, unlike a
    repartition, splits a language too big for one task.
    """
    return rows.hint("rebalance", "language")


def write_clips(clips: DataFrame, out: str, batch: str) -> None:
    """Write one batch of clips and their texts, below a folder per language.

    ``batch`` names what was cut together, such as a manifest's version. A batch
    is replaced as a whole wherever it has rows, and other batches stay as they
    are, so a run that is started twice, or again after a failure, leaves one copy
    of each clip. Skip the clips of other batches before cutting, with
    ``skip_done_clips`` and ``other_clips``. Rows are rebalanced by language, so a
    language has as many files as its bytes ask for, not one from every task.
    """
    (
        _by_language(clips.withColumn("batch", F.lit(batch)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("language", "batch")
        .parquet(out)
    )


def other_clips(spark: SparkSession, out: str, batch: str) -> DataFrame:
    """Clips that batches other than ``batch`` have left below ``out``."""
    found = spark.read.parquet(out)
    return found.where(F.col("batch").cast("string") != batch)


def write_dataset(dataset: DataFrame, out: str) -> None:
    """``(audio, sentence, language)`` as Parquet, one folder per language.

    Replaces only the languages ``dataset`` holds; others stay as they are.
    """
    (
        _by_language(dataset)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("language")
        .parquet(out)
    )


def write_results(results: DataFrame, out: str) -> None:
    """Result sheet as CSV with a header, one folder per language.

    Quotes are doubled inside quoted cells, as spreadsheets expect. Replaces only
    the languages ``results`` holds; others stay as they are.
    """
    (
        _by_language(results)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("language")
        .options(**_SHEET)
        .csv(f"{out}/transcription_results")
    )


def read_results(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """Result sheet with declared types: text is never type-inferred."""
    return (
        spark.read.schema(schema)
        .options(**_SHEET)
        .option("multiLine", True)
        .csv(f"{out}/transcription_results")
    )


def load_datasets(spark: SparkSession, paths: list[str], split: str | None = None) -> DataFrame:
    """All rows of all saved datasets, repeated ones included.

    ``split`` names them, as ``train``, in a column of that name, so that splits
    loaded apart can be told apart. ``language`` is always text.

    ``dataset_no`` is the position in ``paths``; it keeps rows apart that occur
    in several datasets. A path may be a whole dataset or one language of it.
    """
    if not paths:
        raise ValueError("no dataset given")
    parts = []
    for number, path in enumerate(paths):
        base = path.split("/language=")[0]
        found = spark.read.option("basePath", base).parquet(path).schema
        typed = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "language" else f for f in found])
        part = spark.read.option("basePath", base).schema(typed).parquet(path)
        part = part.withColumn("dataset_no", F.lit(number).cast("long"))
        parts.append(part if split is None else part.withColumn("split", F.lit(split)))
    return concat_datasets(*parts)


def concat_datasets(*datasets: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, datasets)
