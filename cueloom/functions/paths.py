"""File name functions. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cueloom.constants import AUDIO_EXTENSION, VIDEO_EXTENSIONS


def path_basename(path: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(path, "/", -1)


def strip_extension(path: Column) -> Column:
    """The path without the extension of its last component.

    Leading dots of a name are not an extension: ``.wav`` stays ``.wav``.
    """
    return F.regexp_replace(path, r"(?s)\A((?:.*/)?\.*[^./][^/]*)\.[^./]*\z", "$1")


def path_stem(path: Column) -> Column:
    """Basename without its extension."""
    return strip_extension(path_basename(path))


def path_rstem(path: Column) -> Column:
    """Everything before the last dot, so ``.wav`` becomes empty."""
    return F.regexp_replace(path, r"\.[^.]*\z", "")


def audio_target(path: Column) -> Column:
    """Name the audio of a fetched media object is stored under."""
    return F.concat(path_rstem(path_basename(path)), F.lit(AUDIO_EXTENSION))


def manifest_audio_name(media_file: Column) -> Column:
    """Audio name the cutting stage looks for, given a manifest cell."""
    return F.concat(strip_extension(media_file), F.lit(AUDIO_EXTENSION))


def _ends_with_any(path: Column, endings: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [path.endswith(e) for e in endings])


def media_kind(path: Column) -> Column:
    """``video``, ``audio_wav`` or ``other``; case-sensitive."""
    return (
        F.when(_ends_with_any(path, VIDEO_EXTENSIONS), "video")
        .when(path.endswith(AUDIO_EXTENSION), "audio_wav")
        .otherwise("other")
    )


def transcript_kind(path: Column) -> Column:
    """``srt``, ``vtt`` or ``unsupported``; case-sensitive."""
    return F.when(path.endswith(".srt"), "srt").when(path.endswith(".vtt"), "vtt").otherwise("unsupported")


def url_unquote(text: Column) -> Column:
    """Percent-decoding that keeps ``+`` and leaves malformed escapes as they are.

    ``url_decode`` turns ``+`` into a space and fails on bad escapes, so both
    are escaped first.
    """
    escaped = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))
