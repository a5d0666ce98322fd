"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cueloom.runtime import delete_path, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Paths of the tables written since the innermost ``forgetting`` began.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage, survives lost executors, and makes every later reader see
    the same rows. The shuffle files behind it go when the write is done, as
    nothing reads them again. Inside ``forgetting`` the table goes at its end, unless ``keep``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    written = _WRITTEN.get()
    if written is not None and not keep:
        written.append(path)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def forgetting(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the tables that ``stored`` writes inside. What is to be read later must be kept."""
    token = _WRITTEN.set([])
    try:
        yield
    finally:
        paths = _WRITTEN.get() or []
        _WRITTEN.reset(token)
        for path in paths:
            delete_path(spark, path)


def set_aside(docs: DataFrame) -> DataFrame:
    """``doc_id, text, _rest``: all other columns in one, so that no name of theirs can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*(rest or [F.lit(0).alias("none")])).alias("_rest"))


def put_back(df: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """The columns that ``set_aside`` was given, in their order, then ``more``."""
    return df.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"_rest.`{c}`").alias(c) for c in columns], *more)


def text_key(text: str = "text") -> Column:
    """Tells rows of equal doc_id apart by their text. Null texts share one key."""
    return F.xxhash64(text)


def id_remainder(name: str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % modulus, F.lit(0).cast("long"))


def hash_sample(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """About ``rows`` rows, the same ones for the same data, whole rows always.

    All rows if there are no more than ``rows``; else each row with the chance
    ``rows / count``, by a hash of ``key``.
    """
    count = df.count()
    if count <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(*key), F.lit(1_000_003)) < int(1_000_003 * rows / count))


def as_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """UTF-8 bytes of a text column."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def as_list(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a step holds for one batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
