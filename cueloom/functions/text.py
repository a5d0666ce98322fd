"""Text functions. All are built-in expressions but for Unicode composition."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueloom.constants import STRICT_PUNCTUATION
from cueloom.functions.python import once

# White_Space plus the four information separators.
UNICODE_SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spans whose content is not speech: (opening, closing, shortest content).
ANNOTATION_SPANS = (("[<", "]>", 0), ("(", ")", 1))


def fold_newlines(body: Column) -> Column:
    """Every line break, of any kind, becomes one space."""
    return F.regexp_replace(body, "\r\n|\r|\n", " ")


def strip_ws(text: Column) -> Column:
    """Drop Unicode whitespace at both ends (plain ``trim`` drops only spaces)."""
    return F.trim(text, F.lit(UNICODE_SPACES))


def _class(chars: str) -> str:
    return "[" + "".join("\\" + c for c in chars) + "]"


def norm_strict(text: Column) -> Column:
    """Lower-case and delete the strict punctuation set, joining what it separated."""
    return F.regexp_replace(F.lower(text), _class(STRICT_PUNCTUATION), "")


@once
@F.arrow_udf(T.StringType())
def _compose(text: pa.Array) -> pa.Array:
    """NFKC; nulls and rows of plain ASCII are passed on untouched."""
    odd = pc.fill_null(pc.invert(pc.string_is_ascii(text)), False)
    composed = [unicodedata.normalize("NFKC", t) for t in text.filter(odd).to_pylist()]
    return pc.replace_with_mask(text, odd, pa.array(composed, text.type))


def _without_spans(text: Column, spans) -> Column:
    """Lower-cased text without annotation spans; text that opens none is not searched."""
    out = lowered = F.lower(text)
    for opening, closing, shortest in spans:
        start, inside = _class(opening), _class(closing).replace("[", "[^", 1)
        # An unclosed span is kept, and matched to the end so that it is read once.
        span = f"{start}{inside}{{{shortest},}}{_class(closing)}|({start}{inside}*\\z)"
        out = F.regexp_replace(out, span, "$1")
    opens = [text.contains(mark) for opening, _, _ in spans for mark in opening]
    return F.when(reduce(lambda a, b: a | b, opens, F.lit(False)), out).otherwise(lowered)


def norm_basic(text: Column, compose: bool = True, spans=ANNOTATION_SPANS) -> Column:
    """Standardise text for training labels and the training metric.

    Drops annotation spans, composes to NFKC, turns marks, symbols, punctuation
    and every kind of whitespace into spaces, lower-cases, collapses and strips.
    ``compose=False`` skips the one step Spark has no built-in for; use it when
    the input is known to be NFKC already, and the plan stays in the JVM.
    """
    out = _without_spans(text, spans)
    if compose:
        # Texts of plain ASCII, as many bytes as characters, stay in the JVM; a null crosses in their place.
        beyond_ascii = F.octet_length(text) != F.length(text)
        out = F.coalesce(_compose(F.when(beyond_ascii, out)), out)
    # Letters, numbers and control characters stay; the rest separates words.
    out = F.regexp_replace(out, r"[[^\p{L}\p{N}\p{C} ][\t-\r\x1c-\x1f\x85]]", " ")
    return F.trim(F.regexp_replace(F.lower(out), " {2,}", " "))


def word_tokens(text: Column) -> Column:
    """Lower-cased words between runs of whitespace; no empty words."""
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")
