"""Files below a folder: listed on the executors, or read whole."""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cueloom.runtime import path_exists, qualified

# Stores that a worker can list by itself; Spark lists the others.
_LISTED = ("", "file", "s3", "s3a", "gs", "hdfs")

# Of these, the ones whose files a worker reads by itself, with no Hadoop client.
_READ = ("file", "s3", "s3a", "gs")

# Folder names at which splitting stops, so that the driver holds few of them.
MAX_PREFIXES = 10_000

LISTING = "path string, length bigint, modificationTime timestamp"
_FILES_IN_BATCH = 10_000
_READ_FILES = ["path", "modificationTime", "content"]
#: Contents that leave a worker at once, unless a single file is larger.
_BYTES_IN_BATCH = 16 * 1024 * 1024


def _is_local(root: str) -> bool:
    return urlparse(root).scheme in ("", "file")


def _base(root: str) -> str:
    """The root's path within its store."""
    url = urlparse(root)
    path = root if not url.scheme else url.path if _is_local(root) else url.netloc + url.path
    return path.rstrip("/") or "/"


def _entries(root: str, folder: str) -> Iterator[tuple[str, int | None, datetime]]:
    """``(path, length, changed)`` of what a folder holds, or of a single file; folders have no length."""
    if _is_local(root):
        if os.path.isfile(folder):
            found = os.stat(folder)
            yield folder, found.st_size, datetime.fromtimestamp(found.st_mtime, UTC)
            return
        with os.scandir(folder) as entries:
            for entry in entries:
                try:
                    found = entry.stat()
                except FileNotFoundError:  # deleted meanwhile, or a link to nothing
                    continue
                length = None if entry.is_dir() else found.st_size
                yield entry.path, length, datetime.fromtimestamp(found.st_mtime, UTC)
        return
    import pyarrow.fs as fs

    store, _ = fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))
    single = store.get_file_info(folder)
    for info in [single] if single.type == fs.FileType.File else store.get_file_info(fs.FileSelector(folder)):
        length = None if info.type == fs.FileType.Directory else info.size
        yield info.path, length, info.mtime or datetime(1970, 1, 1, tzinfo=UTC)


def _named(root: str, path: str) -> str:
    """A listed path as Spark names it."""
    return f"file:{path}" if _is_local(root) else root.rstrip("/") + path[len(_base(root)) :]


def _hidden(path: str, folder: bool) -> bool:
    name = path.rsplit("/", 1)[-1]
    return name.startswith((".", "_"))


def _unread(path: str, folder: bool) -> bool:
    """Whether Spark's file sources pass over a name: hidden, half copied, or no text."""
    name = path.rsplit("/", 1)[-1]
    if not name.isascii() and any("\ud800" <= c <= "\udfff" for c in name):
        return True
    if name.startswith("_") and "=" not in name:
        return not (folder and name.startswith(("_metadata", "_common_metadata")))
    return name.startswith(".") or name.endswith("._COPYING_")


class Prefix(InputPartition):
    """A folder, listed with all below it or by itself."""

    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


class ObjectListing(DataSource):
    """Batch source ``objects``: ``(path, length, modificationTime)`` of the files below ``path``.

    The driver lists folders only, level by level, until there are ``prefixes`` of
    them or none is left; each is a partition, and the executors list the files.
    Names that begin with a dot or underscore are left out, as Spark leaves them out;
    with ``sources`` the names that Spark's file sources leave out, and no others.
    """

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> DataSourceReader:
        return _ObjectReader(self.options)


class _ObjectReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.wanted = min(int(options.get("prefixes", "64")), MAX_PREFIXES)
        self.left_out = _unread if "sources" in options else _hidden

    def partitions(self) -> list[Prefix]:
        whole, level = [], [_base(self.root)]
        # A folder that is split stays as a partition of its own files.
        while level and len(whole) + len(level) < self.wanted:
            below = []
            for folder in level:
                whole.append(Prefix(folder, False))
                below += [p for p, length, _ in _entries(self.root, folder) if length is None and not self.left_out(p, True)]
            level = below
        return whole + [Prefix(folder, True) for folder in level]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        rows, folders = [], [partition.path]

        def batch() -> pa.RecordBatch:
            paths, lengths, times = zip(*rows, strict=True)
            arrays = [pa.array(paths), pa.array(lengths, pa.int64()), pa.array(times, pa.timestamp("us", "UTC"))]
            return pa.RecordBatch.from_arrays(arrays, ["path", "length", "modificationTime"])

        while folders:
            for path, length, changed in _entries(self.root, folders.pop()):
                if self.left_out(path, length is None):
                    continue
                if length is None:
                    if partition.deep:
                        folders.append(path)
                    continue
                rows.append((_named(self.root, path), length, changed))
                if len(rows) >= _FILES_IN_BATCH:
                    yield batch()
                    rows = []
        if rows:
            yield batch()


def list_objects(spark: SparkSession, root: str, prefixes: int = 64) -> DataFrame:
    """``(path, length, modificationTime)`` of every file below ``root``.

    Files are listed by the executors, folder by folder, and none is opened; the
    driver sees at most about ``prefixes`` folder names. Stores that the workers
    have no client for are listed by Spark's own file index. Save the result with
    ``write_listing`` if it is used more than once: each use lists anew.
    """
    if urlparse(root).scheme in _LISTED:
        spark.dataSource.register(ObjectListing)
        return spark.read.format("objects").option("prefixes", prefixes).load(root)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return found.select("path", "length", "modificationTime")


def is_pattern(path: str) -> bool:
    """Whether Spark takes a path for a pattern of paths."""
    return not set(path).isdisjoint("{}[]*?\\")


def read_by_workers(spark: SparkSession, root: str) -> bool:
    """Whether workers list and read what is below ``root`` by themselves, as ``list_files`` and ``read_files`` do.

    That takes a local folder, or a store whose client finds the root; no pattern, and no output
    of a stream, whose own log says which files count.
    """
    if is_pattern(root):
        return False
    at = qualified(spark, root)
    scheme = at.partition(":")[0]
    if scheme not in _READ or "#" in at or path_exists(spark, f"{at}/_spark_metadata"):
        return False
    if scheme == "file":
        return path_exists(spark, at)
    import pyarrow.fs as fs

    try:
        store, _ = fs.FileSystem.from_uri(at.replace("s3a://", "s3://", 1))
        return store.get_file_info(_base(at)).type != fs.FileType.NotFound
    except (OSError, pa.ArrowException):
        return False


def list_files(spark: SparkSession, root: str, prefixes: int = 64) -> DataFrame:
    """``list_objects`` of the files that Spark's file sources would read below ``root``, for ``read_files``."""
    spark.dataSource.register(ObjectListing)
    at = qualified(spark, root)
    root = at[len("file:") :] if at.startswith("file:") else at
    return spark.read.format("objects").option("prefixes", prefixes).option("sources", "true").load(root)


def _content(path: str, stores: dict) -> bytes | None:
    """What a listed file holds, or nothing if it is gone or not a plain file."""
    try:
        if path.startswith("file:"):
            local = path[len("file:") :]
            if not os.path.isfile(local):
                return None
            with open(local, "rb") as file:
                return file.read()
        import pyarrow.fs as fs

        scheme, _, at = path.partition("://")
        bucket = f"{scheme.replace('s3a', 's3')}://{at.partition('/')[0]}"
        if bucket not in stores:
            stores[bucket], _ = fs.FileSystem.from_uri(bucket)
        with stores[bucket].open_input_stream(at, compression=None) as file:
            return file.read()
    except FileNotFoundError:
        return None


def _with_content(batch: pa.RecordBatch, at: list[int], bodies: list[bytes]) -> pa.RecordBatch:
    """Rows ``at`` of a batch of listed files with their contents."""
    paths, changed = (batch.column(i).take(pa.array(at, pa.int32())) for i in (0, 1))
    return pa.RecordBatch.from_arrays([paths, changed, pa.array(bodies, pa.binary())], _READ_FILES)


def read_files(files: DataFrame) -> DataFrame:
    """``(path, modificationTime, content)`` of listed files, read where their rows are.

    A file that has no byte, or was deleted since it was listed, gives no row.
    """

    def run(batches):
        stores: dict = {}
        for batch in batches:
            at, bodies, held = [], [], 0
            for i, path in enumerate(batch.column(0).to_pylist()):
                body = _content(path, stores)
                if not body:
                    continue
                if at and held + len(body) > _BYTES_IN_BATCH:
                    yield _with_content(batch, at, bodies)
                    at, bodies, held = [], [], 0
                at.append(i)
                bodies.append(body)
                held += len(body)
            if at:
                yield _with_content(batch, at, bodies)

    return files.select(*_READ_FILES[:2]).mapInArrow(run, "path string, modificationTime timestamp, content binary")


def write_listing(spark: SparkSession, root: str, out: str, prefixes: int = 64) -> DataFrame:
    """List ``root`` once into a table at ``out``, which replaces an earlier listing, and return that table."""
    list_objects(spark, root, prefixes).write.mode("overwrite").parquet(out)
    return read_listing(spark, out)


def read_listing(spark: SparkSession, out: str) -> DataFrame:
    """A saved listing."""
    return spark.read.schema(LISTING).parquet(out)


def read_transcripts(spark: SparkSession, root: str) -> DataFrame:
    """One row ``(path, body)`` per subtitle or text file below ``root``.

    Paths are those of ``list_objects``, as they are on disk: nothing is percent-encoded.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.col("content").cast("string").alias("body"))
