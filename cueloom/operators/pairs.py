"""Pairing media with transcripts, and line-aligned lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueloom.constants import PROGRESS_EVERY, PROGRESS_OFFSET
from cueloom.errors import AlignmentError
from cueloom.functions.paths import path_basename, path_stem, strip_extension, url_unquote
from cueloom.functions.text import strip_ws
from cueloom.operators.ordering import with_position
from cueloom.runtime import checkpointed


def _keyed_media(media: DataFrame, by: list[str]) -> DataFrame:
    return media.select(*by, F.col("path").alias("media_path"), url_unquote(path_stem(F.col("path"))).alias("_key"))


def _first_transcripts(transcripts: DataFrame, by: list[str]) -> DataFrame:
    """One transcript per decoded stem; many files of one stem meet in partial aggregates."""
    key = strip_extension(url_unquote(path_basename(F.col("path"))))
    return (
        transcripts.select(*by, key.alias("_key"), "path")
        .groupBy(*by, "_key")
        .agg(F.min("path").alias("transcript_path"))
    )


def pair_clips(media: DataFrame, transcripts: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(by…, media_path, transcript_path)`` for media whose decoded stem has a transcript.

    Media names lose their extension before decoding, transcript names after.
    The smallest transcript path wins. Start from on-disk paths: an already
    percent-encoded one would be decoded twice.
    """
    by = list(by)
    pairs = _keyed_media(media, by).join(_first_transcripts(transcripts, by), [*by, "_key"])
    return pairs.select(*by, "media_path", "transcript_path")


def unpaired_media(media: DataFrame, transcripts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Media without a transcript."""
    by = list(by)
    rest = _keyed_media(media, by).join(_first_transcripts(transcripts, by), [*by, "_key"], "left_anti")
    return rest.select(*by, "media_path")


def zip_lines(left: DataFrame, right: DataFrame, names: tuple[str, str] = ("media", "sentence")) -> DataFrame:
    """Line *i* of one list with line *i* of the other.

    Lists of different length are refused: every pair after a missing line
    would be wrong. The numbering of both is checkpointed, as it is read to count
    and to join.
    """
    left, right = checkpointed(left), checkpointed(right)
    sizes = [side.agg(F.count("*").alias("n"), F.lit(i).alias("side")) for i, side in enumerate((left, right))]
    counts = {row["side"]: row["n"] for row in sizes[0].union(sizes[1]).collect()}
    if counts[0] != counts[1]:
        raise AlignmentError(f"{counts[0]} {names[0]} lines but {counts[1]} {names[1]} lines")
    return left.select("line_no", F.col("value").alias(names[0])).join(
        right.select("line_no", F.col("value").alias(names[1])), "line_no"
    )


def audio_exists(pairs: DataFrame, listing: DataFrame, path: str = "audio_path") -> DataFrame:
    """Pairs whose audio is listed."""
    return pairs.join(listing.select(F.col("path").alias(path)).distinct(), path, "left_semi").select(*pairs.columns)


def is_scorable(
    reference: str = "reference", hypothesis: str = "hypothesis", blank_is_empty: bool = True
) -> Column:
    """Neither side null, empty or (by default) blank."""

    def filled(name: str) -> Column:
        text = F.col(name)
        return F.coalesce(strip_ws(text) != "" if blank_is_empty else text != "", F.lit(False))

    return filled(reference) & filled(hypothesis)


def nonempty_pairs(
    pairs: DataFrame, reference: str = "reference", hypothesis: str = "hypothesis", blank_is_empty: bool = True
) -> DataFrame:
    """Pairs worth scoring."""
    return pairs.where(is_scorable(reference, hypothesis, blank_is_empty))


def progress_sample(scored: DataFrame, order: list[str], by: str = "language") -> DataFrame:
    """Rows to report while scoring: positions 10, 110, 210, … of each language.

    ``order`` must identify a row within its language. Only the columns of the
    order are sorted and numbered; whole rows are then fetched for the one in a
    hundred that is reported.
    """
    numbered = with_position(scored.select(by, *order), order, by)
    chosen = numbered.where(F.col("position") % PROGRESS_EVERY == PROGRESS_OFFSET)
    if set(scored.columns) == {by, *order}:
        return chosen.select(*scored.columns, "position")
    named = chosen.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate([by, *order])], "position")
    same = [scored[c].eqNullSafe(named[f"_{i}"]) for i, c in enumerate([by, *order])]
    return scored.join(named, reduce(lambda a, b: a & b, same)).select(*scored.columns, "position")
