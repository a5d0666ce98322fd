"""Skip-what-is-done as a file stream: only new subtitle files are read and parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cueloom.operators.cues import clip_ids, cues_and_status
from cueloom.runtime import delete_path, make_folder, path_exists
from cueloom.sources.listing import LISTING, is_pattern, list_files, read_by_workers, read_files, read_listing

_BINARY_FILES = "path string, modificationTime timestamp, length long, content binary"

#: A batch costs some fixed time, however few its files are.
FILES_PER_TRIGGER = 20_000
#: A small file counts as so many bytes when files are dealt to tasks.
_OPEN_BYTES = 128 * 1024


def _for_small_files(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` that lists and reads many files in a task, not one and a few."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    tasks = 4 * spark.sparkContext.defaultParallelism
    own.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))
    own.conf.set("spark.sql.files.openCostInBytes", str(_OPEN_BYTES))
    return own


def new_files(spark: SparkSession, root: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Stream ``(path, modified, body)`` of the files that appear anywhere below ``root``, by Spark's file index.

    The driver holds all files there are, some 2 KB each. Files without a byte give no row, as Spark
    plans no split for them; a listing shows them.
    """
    source = (
        _for_small_files(spark)
        .readStream.format("binaryFile")
        .schema(_BINARY_FILES)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(root)
    )
    return source.select(
        "path", F.col("modificationTime").alias("modified"), F.col("content").cast("string").alias("body")
    )


def _list_new(spark: SparkSession, root: str, listed: str, files_per_trigger: int) -> None:
    """Add the files below ``root`` that a listing table lacks to it, so many to a file of the table.

    A path is looked up in all that the table has, so a run that broke off while it added to the table
    leaves no gap and no path twice.
    """
    kept, found = f"{listed}-now", list_files(spark, root)
    if path_exists(spark, listed):
        # Merged, as a broadcast would bring the paths to the driver.
        found = found.join(read_listing(spark, listed).select("path").hint("merge"), "path", "left_anti")
    found.write.mode("overwrite").parquet(kept)
    new = read_listing(spark, kept)
    make_folder(spark, listed)
    if count := new.count():
        new.repartition(-(-count // files_per_trigger)).write.mode("append").parquet(listed)
    delete_path(spark, kept)


def listed_files(spark: SparkSession, listed: str) -> DataFrame:
    """``new_files`` by a listing table: a trigger takes one file of the table, and its tasks read what that names."""
    rows = spark.readStream.schema(LISTING).option("maxFilesPerTrigger", 1).parquet(listed)
    read = read_files(rows.repartition(4 * spark.sparkContext.defaultParallelism))
    return read.select(
        "path",
        F.date_trunc("millisecond", "modificationTime").alias("modified"),
        F.col("content").cast("string").alias("body"),
    )


def new_cues(files: DataFrame) -> DataFrame:
    """Cues of a stream of files with clip names, and a row with its status for each file that has none."""
    named = clip_ids(cues_and_status(files))
    return named.withColumn("clip_id", F.when(F.col("cue_no").isNotNull(), F.col("clip_id")))


def _files_since(spark: SparkSession, root: str, checkpoint: str) -> DataFrame:
    """The stream of files that a checkpoint was begun with; a new one is by listing table wherever workers can."""
    listed, begun = (f"{checkpoint.rstrip('/')}/{name}" for name in ("listed", "offsets"))
    if not path_exists(spark, listed):
        if path_exists(spark, begun) or is_pattern(checkpoint) or not read_by_workers(spark, root):
            return new_files(spark, root)
    _list_new(spark, root, listed, FILES_PER_TRIGGER)
    return listed_files(spark, listed)


def append_new_cues(spark: SparkSession, root: str, out: str, checkpoint: str) -> StreamingQuery:
    """Parse the files that arrived below ``root`` since the last run, append to ``out``, and stop.

    The stream checkpoint plays the part of the existence test: a file is read
    once, also after a failure, and the file sink commits each batch whole. A file
    that is written anew under its old name is not read again.

    The names of the files are in a table below the checkpoint, listed and compared by the executors:
    the driver holds none of them. One run at a time may use a checkpoint, and it stays where it was
    begun. Where only Spark reaches the files, and for checkpoints begun without the table, it is ``new_files``.
    """
    return (
        new_cues(_files_since(spark, root, checkpoint))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def file_status(cues: DataFrame) -> DataFrame:
    """``(path, status, blocks, cues)``: one row a file of what ``append_new_cues`` has left."""
    return cues.groupBy("path", "status", "blocks").agg(F.count("cue_no").alias("cues"))
