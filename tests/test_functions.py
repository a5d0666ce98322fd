"""Column functions on hand-made cases, against plain Python where it defines the result."""

import os
import re
import string
import unicodedata
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from cueloom.functions import cues, paths, signal, text

NAMES = ["a.wav", ".wav", "a.tar.gz", "nodot", "..a.b", "...", "a.", "d.x/b", "d/.hidden", "d/a.b.c", "", "/x/y.mp4"]
NAMES += ["ä ö.srt", "two\nlines.srt"]


def apply(spark, values, function, schema="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}").coalesce(1)
    return [r["x"] for r in rows.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "function, expected",
    [
        (paths.path_basename, os.path.basename),
        (paths.strip_extension, lambda p: os.path.splitext(p)[0]),
        (paths.path_stem, lambda p: os.path.splitext(os.path.basename(p))[0]),
        (paths.path_rstem, lambda p: p.rsplit(".", 1)[0]),
        (paths.audio_target, lambda p: os.path.basename(p).rsplit(".", 1)[0] + ".wav"),
        (paths.manifest_audio_name, lambda p: os.path.splitext(p)[0] + ".wav"),
    ],
)
def test_paths_equal_python(spark, function, expected):
    assert apply(spark, NAMES, function) == [expected(n) for n in NAMES]


def test_kinds_are_case_sensitive(spark):
    names = ["a.mp4", "a.avi", "a.mov", "a.m4v", "a.MP4", "a.wav", "a.mp3", "mp4", "a.srt", "a.vtt", "a.SRT", "a.txt"]
    assert apply(spark, names, paths.media_kind) == ["video"] * 4 + ["other", "audio_wav"] + ["other"] * 6
    assert apply(spark, names, paths.transcript_kind)[8:] == ["srt", "vtt", "unsupported", "unsupported"]


def test_unquote_equals_python(spark):
    samples = ["a+b%20c", "%zz%41", "a%2", "100%", "%C3%A9t%c3%a9", "é%20ü", "%25%32%35", "%FFx", "+%2B+", ""]
    assert apply(spark, samples, paths.url_unquote) == [unquote(s) for s in samples]


def test_newlines_fold_to_one_space(spark):
    assert apply(spark, ["a\r\nb\rc\nd\n\ne"], text.fold_newlines) == ["a b c d  e"]


def test_strip_equals_python(spark):
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    samples = [spaces + "a b" + spaces, "​x​", " ", "", "a ", "﻿b"]
    assert apply(spark, samples, text.strip_ws) == [s.strip() for s in samples]


def test_strict_normaliser_joins(spark):
    assert apply(spark, ["Well-Known, it's [x]+=|`"], text.norm_strict) == ["wellknown its x+=|`"]
    kept = set(string.punctuation) - set(apply(spark, ["a" + string.punctuation], text.norm_strict)[0])
    assert kept == set(string.punctuation) - set("+=|`")


def _basic(value):
    out = value.lower()
    out = re.sub(r"[<\[][^>\]]*[>\]]", "", out)
    out = re.sub(r"\([^)]+\)", "", out)
    out = "".join(" " if unicodedata.category(c)[0] in "MSP" else c for c in unicodedata.normalize("NFKC", out))
    return " ".join(re.sub(r"\s+", " ", out.lower()).split())


def test_basic_normaliser(spark):
    samples = [
        "Hello, [laughs] World! (aside) <b>x</b>",
        "café ﬁn ½ ＡＢ",
        "a b c\x1cd\x85e f",
        "no(t closed [either",
        "() [] <>",
        "tab\tline\r\nend  ",
        "İstanbul naïve coöp €5 + 3 = 8",
        "हिन्दी",
        "a (b) (((c",
        "[x] <<y",
        "((a) b) ()c) (\n)",
        "",
    ]
    assert apply(spark, samples, text.norm_basic) == [_basic(s) for s in samples]
    assert apply(spark, [samples[0]], lambda c: text.norm_basic(c, compose=False)) == ["hello world x"]


def test_unclosed_spans_are_read_once(spark):
    many = 300_000
    samples = ["a (b) " + "(" * many + "c", "[x] y" + "<" * many, "(" * many + ") z"]
    assert apply(spark, samples, text.norm_basic) == ["a c", "y", "z"]


def test_word_tokens(spark):
    assert apply(spark, ["  A b\t\nC ", "", "  "], text.word_tokens) == [["a", "b", "c"], [], []]


def test_tags(spark):
    values = ["<v Ann>a <b>c</b>", "x < y", "<" * 100_000, "a<>b"]
    assert apply(spark, values, cues.strip_tags) == ["a c", "x < y", "<" * 100_000, "ab"]


def test_clock(spark):
    values = ["01:02:03,004", "02:03.004", "100:00:00.000"]
    assert apply(spark, values, cues.clock_ms) == [3723004, 123004, 360000000]


def test_mixdown(spark):
    rows = [([1.0, 3.0, -2.0, 4.0], 2), ([1.0, 2.0], 1), ([], 2), ([3.0, 6.0, 9.0], 3)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s array<float>, c int").coalesce(1)
    mixed = [r[0] for r in frame.orderBy("i").select(signal.mixdown(F.col("s"), F.col("c"))).collect()]
    assert mixed == [[2.0, 1.0], [1.0, 2.0], [], [6.0]]
