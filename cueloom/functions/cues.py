"""Subtitle text to cue blocks and milliseconds. All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Any number of digits, as long as the milliseconds fit a long integer.
_DIGITS = r"0*\d{1,11}"
_SRT_CLOCK = rf"{_DIGITS}:{_DIGITS}:{_DIGITS}[,.]{_DIGITS}"
_VTT_CLOCK = rf"(?:{_DIGITS}:)?{_DIGITS}:{_DIGITS}\.{_DIGITS}"


def _timing(clock: str) -> str:
    return rf"[ \t]*{clock}[ \t]*-->[ \t]*{clock}"


# A cue block: at most one line (index or cue id) before the timing line.
SRT_TIMING = _timing(_SRT_CLOCK)
VTT_TIMING = _timing(_VTT_CLOCK)


def is_cue(block: Column, timing: str) -> Column:
    return block.rlike(rf"\A(?:[^\n]*\n)?{timing}(?:[ \t][^\n]*)?(?:\n|\z)")


def subtitle_blocks(body: Column) -> Column:
    """The blank-line separated blocks of a subtitle text, in order."""
    plain = F.regexp_replace(F.regexp_replace(body, "\\A\ufeff", ""), "\r\n?", "\n")
    blocks = F.split(F.trim(plain, F.lit(" \t\n")), r"\n[ \t\n]*\n")
    return F.array_remove(blocks, "")


def clock_ms(clock: Column) -> Column:
    """``[h:]m:s,ms`` or ``[h:]m:s.ms`` as milliseconds; the hour is optional."""
    parts = F.regexp_extract_all(clock, F.lit(r"(\d+)"), F.lit(1))

    def part(index: int) -> Column:
        return F.coalesce(F.try_element_at(parts, F.lit(index)), F.lit("0")).cast("long")

    return ((part(-4) * 60 + part(-3)) * 60 + part(-2)) * 1000 + part(-1)


def cue_clocks(block: Column, timing: str) -> tuple[Column, Column]:
    """Start and end clock text of a cue block."""
    line = F.regexp_extract(block, timing, 0)
    return F.substring_index(line, "-->", 1), F.substring_index(line, "-->", -1)


def cue_text(block: Column, timing: str) -> Column:
    """Lines after the timing line, joined by newlines as they stand."""
    return F.regexp_replace(block, rf"\A(?:[^\n]*\n)?{timing}[^\n]*\n?", "")


def strip_tags(text: Column) -> Column:
    """Text without ``<…>``; an unclosed ``<`` stays."""
    return F.regexp_replace(text, r"<[^>]*>|(<[^>]*\z)", "$1")
