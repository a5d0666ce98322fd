"""Session settings, shared scratch space and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueloom.errors import ScratchDirError

# A build side above this many bytes is shuffled instead of broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "cueloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are planned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    do without: it gets a folder of its own, since driver and executors share
    one machine there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ScratchDirError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cueloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that nothing else uses."""
    return f"{scratch_dir(spark).rstrip('/')}/cueloom/{label}-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, path: str):
    """A path and its store, as Spark's writers see them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any store that Spark writes to; nothing happens if there is none."""
    at, store = _stored(spark, path)
    store.delete(at, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    at, store = _stored(spark, path)
    return store.exists(at)


def make_folder(spark: SparkSession, path: str) -> None:
    at, store = _stored(spark, path)
    store.mkdirs(at)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the store that Spark takes it to be in."""
    at, store = _stored(spark, path)
    return store.makeQualified(at).toString()


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables below the scratch folder.

    For the end of a run: results that were not written yet may still read them.
    """
    delete_path(spark, f"{scratch_dir(spark).rstrip('/')}/cueloom")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster that does not have it installed.

    The driver serves the archive whenever an executor starts, so it stays until the driver ends.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="cueloom-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(os.path.join(folder, "cueloom"), "zip", root, "cueloom")
    spark.sparkContext.addPyFile(archive)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later readers see the same rows in the same partitions."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` holds at most ``max_bytes``. Runs one aggregate over it."""
    widths = [
        F.coalesce(F.octet_length(field.name), F.lit(0))
        if isinstance(field.dataType, T.StringType)
        else F.lit(8)
        for field in df.schema.fields
    ]
    row_bytes = reduce(lambda a, b: a + b, widths, F.lit(16))
    size = df.agg(F.sum(row_bytes.cast("long")).alias("bytes")).first()["bytes"]
    return (size or 0) <= max_bytes


def spread(scan: DataFrame) -> DataFrame:
    """Give every core a share of a scan that has fewer splits than cores.

    A small file is one split, however much work each of its rows is. Scans that
    already fill the cluster are returned as they are. Only for plain scans:
    counting the partitions of a plan with shuffles would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
