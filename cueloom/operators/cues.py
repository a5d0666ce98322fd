"""Subtitle files to cues, clip names, and clips already cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueloom.functions.cues import (
    SRT_TIMING,
    VTT_TIMING,
    clock_ms,
    cue_clocks,
    cue_text,
    is_cue,
    strip_tags,
    subtitle_blocks,
)
from cueloom.functions.paths import path_stem, transcript_kind

_TIMING = {"srt": SRT_TIMING, "vtt": VTT_TIMING}


def _is_comment(block: Column) -> Column:
    return block.rlike(r"\A(?:NOTE|STYLE|REGION)(?:[ \t\n]|\z)")


def _kind_blocks(body: str, kind: str) -> Column:
    timing = _TIMING[kind]
    keep = (lambda b: is_cue(b, timing) & ~_is_comment(b)) if kind == "vtt" else (lambda b: is_cue(b, timing))
    return F.filter(subtitle_blocks(F.col(body)), keep)


def _by_kind(kind: Column, pick) -> Column:
    return F.when(kind == "vtt", pick("vtt")).otherwise(pick("srt"))


def _cue_columns(kind: Column, block: Column) -> list[Column]:
    """Number, times and text of a block at place ``_at``."""
    text = _by_kind(
        kind,
        lambda k: strip_tags(cue_text(block, _TIMING[k])) if k == "vtt" else cue_text(block, _TIMING[k]),
    )
    return [
        (F.col("_at") + 1).cast("long").alias("cue_no"),
        *[
            clock_ms(_by_kind(kind, lambda k, i=i: cue_clocks(block, _TIMING[k])[i])).alias(name)
            for i, name in enumerate(("start_ms", "end_ms"))
        ],
        text.alias("text"),
    ]


def parse_cues(files: DataFrame, kind: Column, body: str = "body") -> DataFrame:
    """Cues of every file in one pass: ``cue_no`` from 1, times in ms, ``text``.

    ``kind`` is ``srt`` or ``vtt`` per row. Other columns are kept. Files without
    a cue give no row; see ``rejected_blocks`` for what was left out.
    """
    keep = [c for c in files.columns if c != body]
    blocks = files.select(
        *keep,
        kind.alias("_kind"),
        F.posexplode(_by_kind(kind, lambda k: _kind_blocks(body, k))).alias("_at", "_block"),
    )
    return blocks.select(*keep, *_cue_columns(F.col("_kind"), F.col("_block")))


def srt_cues(files: DataFrame, body: str = "body") -> DataFrame:
    """Cues of SRT files; tags and inner line breaks stay in the text."""
    return parse_cues(files, F.lit("srt"), body)


def vtt_cues(files: DataFrame, body: str = "body") -> DataFrame:
    """Cues of WebVTT files; header, comments, styles, settings and tags go."""
    return parse_cues(files, F.lit("vtt"), body)


def all_cues(files: DataFrame, path: str = "path", body: str = "body") -> DataFrame:
    """Cues of a mixed set of files, by file name; unsupported ones give none."""
    kind = transcript_kind(F.col(path))
    return parse_cues(files.where(kind != "unsupported"), kind, body)


def _file_status(kind: Column, body: str) -> tuple[Column, Column]:
    """Status of a file and how many of its blocks are no cue."""
    plain = subtitle_blocks(F.col(body))
    srt_bad = F.size(F.filter(plain, lambda b: ~is_cue(b, SRT_TIMING)))
    vtt_bad = F.size(
        F.filter(
            plain, lambda b: ~is_cue(b, VTT_TIMING) & ~_is_comment(b) & ~b.rlike(r"\A\ufeff?WEBVTT(?:[ \t\n]|\z)")
        )
    )
    bad = F.when(kind == "srt", srt_bad).when(kind == "vtt", vtt_bad).otherwise(0).cast("long")
    status = F.when(kind == "unsupported", "unsupported").when(bad > 0, "bad_blocks").otherwise("parsed")
    return status, bad


def rejected_blocks(files: DataFrame, path: str = "path", body: str = "body") -> DataFrame:
    """``(…, status, blocks)`` per file: blocks that are no cue, unsupported files.

    A bad block never costs the file its other cues.
    """
    status, bad = _file_status(transcript_kind(F.col(path)), body)
    return files.withColumn("status", status).withColumn("blocks", bad).drop(body)


def cues_and_status(files: DataFrame, path: str = "path", body: str = "body") -> DataFrame:
    """Cues of a mixed set of files with each file's ``status`` and ``blocks``, in one pass.

    A file that gives no cue has one row with null cue columns and says why:
    ``unsupported``, ``unreadable`` (no body), ``no_cue``. Others are ``parsed``, or
    ``bad_blocks`` with the number of blocks left out.
    """
    keep = [c for c in files.columns if c != body]
    kind = transcript_kind(F.col(path))
    status, bad = _file_status(kind, body)
    found = F.when(kind != "unsupported", _by_kind(kind, lambda k: _kind_blocks(body, k)))
    status = (
        F.when(kind == "unsupported", "unsupported")
        .when(F.col(body).isNull(), "unreadable")
        .when(F.size(found) == 0, "no_cue")
        .otherwise(status)
    )
    # Judged before the blocks are rows: beside the explosion it would be done again for each of them.
    judged = files.select(
        *keep,
        kind.alias("_kind"),
        status.alias("status"),
        F.coalesce(bad, F.lit(0).cast("long")).alias("blocks"),
        found.alias("_found"),
    )
    blocks = judged.select(*keep, "_kind", "status", "blocks", F.posexplode_outer("_found").alias("_at", "_block"))
    parsed = blocks.select(*keep, "status", "blocks", "_at", *_cue_columns(F.col("_kind"), F.col("_block")))
    there = [F.when(F.col("_at").isNotNull(), F.col(c)).alias(c) for c in ("cue_no", "start_ms", "end_ms", "text")]
    return parsed.select(*keep, "status", "blocks", *there)


def clip_ids(cues: DataFrame, path: str = "path") -> DataFrame:
    """Add ``clip_id``: the file's stem and the cue's number in the file."""
    return cues.withColumn(
        "clip_id", F.concat(path_stem(F.col(path)), F.lit("_"), F.col("cue_no").cast("string"))
    )


def skip_done_clips(cues: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Cues whose clip and text are not both there yet.

    ``done`` has one row per finished clip. Name collisions cannot hide a clip:
    the key holds the recording, not only its stem.
    """
    return cues.join(done.select(*key).distinct(), key, "left_anti")
