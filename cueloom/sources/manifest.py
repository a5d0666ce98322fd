from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueloom.errors import ManifestError

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("manifest_id", T.LongType()),
        T.StructField("media_file", T.StringType()),
        T.StructField("transcript_file", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)

# Quoted cells may hold quotes (doubled) and line breaks, as spreadsheets write them.
_OPTIONS = {"csv": {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}}


def read_manifest(
    spark: SparkSession, path: str, fmt: str = "csv", columns: dict[str, str] | None = None
) -> DataFrame:
    """The manifest, typed by ``MANIFEST_SCHEMA``.

    Columns are found by name, in any order; ``columns`` maps a name of the schema
    to the one in the file, as ``{"media_file": "Audio/Video"}``. Without a
    ``manifest_id`` in the file rows are numbered, uniquely but not densely. An
    unreadable or empty manifest, or one without a column, raises ``ManifestError``,
    so that nothing runs on it.
    """
    named = {f.name: (columns or {}).get(f.name, f.name) for f in MANIFEST_SCHEMA}
    try:
        found = spark.read.format(fmt).options(**_OPTIONS.get(fmt, {})).load(path)
        empty = found.isEmpty()
    except AnalysisException as error:
        raise ManifestError(f"cannot read manifest {path}") from error
    if empty:
        raise ManifestError(f"manifest {path} has no rows")
    missing = [name for own, name in named.items() if name not in found.columns and own != "manifest_id"]
    if missing:
        raise ManifestError(f"manifest {path} has no column {', '.join(missing)}")
    numbered = named["manifest_id"] in found.columns
    values = {
        own: F.col(f"`{name}`") if own != "manifest_id" or numbered else F.monotonically_increasing_id()
        for own, name in named.items()
    }
    return found.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA])
