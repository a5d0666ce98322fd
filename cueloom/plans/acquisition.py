"""What to fetch, what to cut, and a count of every outcome."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueloom.functions.paths import audio_target, manifest_audio_name, media_kind, path_basename, transcript_kind
from cueloom.operators.manifest import flag_listed, is_excluded, listed_names, resolve_names


def _flagged(rows: DataFrame, names: DataFrame, key: str, flag: str) -> DataFrame:
    """Left join against distinct names, adding whether there was a match."""
    marked = names.withColumn(flag, F.lit(True))
    return rows.join(marked, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def acquisition_plan(
    manifest: DataFrame,
    listing: DataFrame,
    present: DataFrame,
    emails: list[str] = (),
    domains: list[str] = (),
    excluded_texts: DataFrame | None = None,
) -> DataFrame:
    """One ``status`` per manifest row, with the objects to fetch.

    The first that applies: ``incomplete``, ``unresolved``, ``excluded``,
    ``present``, ``to_fetch``. ``present`` looks at the audio alone;
    ``transcript_present`` tells a lost transcript. ``emails`` and ``domains`` are
    short lists; ``excluded_texts`` (one column) adds a list of any length.
    """
    resolved = (
        resolve_names(manifest, listing, {"media_file": "media_path", "transcript_file": "transcript_path"})
        .withColumn("audio_name", audio_target(F.col("media_path")))
        .withColumn("_transcript", path_basename(F.col("transcript_path")))
    )
    flagged = _flagged(resolved, listed_names(present, "audio_name"), "audio_name", "audio_present")
    flagged = _flagged(flagged, listed_names(present, "_transcript"), "_transcript", "transcript_present")
    excluded = is_excluded(F.col("media_path"), emails, domains) | is_excluded(
        F.col("transcript_path"), emails, domains
    )
    if excluded_texts is not None:
        flagged = flag_listed(flagged, ["media_path", "transcript_path"], excluded_texts, "_listed")
        excluded = excluded | F.col("_listed")
    status = (
        F.when(F.col("media_file").isNull() | F.col("transcript_file").isNull(), "incomplete")
        .when(F.col("media_path").isNull() | F.col("transcript_path").isNull(), "unresolved")
        .when(excluded, "excluded")
        .when(F.col("audio_present"), "present")
        .otherwise("to_fetch")
    )
    return flagged.select(
        *manifest.columns,
        "media_path",
        "transcript_path",
        media_kind(F.col("media_path")).alias("media_kind"),
        "audio_name",
        "transcript_present",
        status.alias("status"),
    )


def cutting_plan(manifest: DataFrame, audio: DataFrame, transcripts: DataFrame) -> DataFrame:
    """One ``status`` per manifest row: ``incomplete``, ``missing``, ``unsupported`` or ``to_cut``."""
    rows = manifest.withColumn("_audio", manifest_audio_name(F.col("media_file")))
    rows = _flagged(rows, listed_names(audio, "_audio"), "_audio", "_has_audio")
    rows = _flagged(rows, listed_names(transcripts, "transcript_file"), "transcript_file", "_has_transcript")
    status = (
        F.when(F.col("media_file").isNull() | F.col("transcript_file").isNull(), "incomplete")
        .when(~F.col("_has_audio") | ~F.col("_has_transcript"), "missing")
        .when(transcript_kind(F.col("transcript_file")) == "unsupported", "unsupported")
        .otherwise("to_cut")
    )
    return rows.select(*manifest.columns, status.alias("status"))


def run_summary(stages: dict[str, DataFrame]) -> DataFrame:
    """``(stage, status, n)`` over the status columns of all stages."""
    outcomes = [df.select(F.lit(name).alias("stage"), "status") for name, df in stages.items()]
    return reduce(DataFrame.unionByName, outcomes).groupBy("stage", "status").agg(F.count("*").alias("n"))
