"""Word error rate over pairs, languages and the corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueloom.functions.scoring import edit_counts, edit_distance
from cueloom.functions.text import norm_strict, word_tokens
from cueloom.operators.pairs import is_scorable, nonempty_pairs

Normaliser = Callable[[Column], Column]


def _normalised(pairs: DataFrame, normalise: Normaliser) -> DataFrame:
    return pairs.withColumns({c: normalise(F.col(c)) for c in ("reference", "hypothesis")})


def normalised(pairs: DataFrame, normalise: Normaliser = norm_strict) -> DataFrame:
    """Both sides normalised, pairs with an empty side dropped.

    The two normalisers give error rates that cannot be compared, so the choice
    is an argument.
    """
    return nonempty_pairs(_normalised(pairs, normalise))


def with_edits(pairs: DataFrame) -> DataFrame:
    """Add ``ref_words``, ``edits``, the edits by kind, and ``hits``, from one alignment."""
    words = [word_tokens(F.col(c)) for c in ("reference", "hypothesis")]
    counted = pairs.withColumn("ref_words", F.size(words[0]).cast("long")).withColumn("_counts", edit_counts(*words))
    return counted.select(*pairs.columns, "ref_words", "_counts.*")


def score(pairs: DataFrame, normalise: Normaliser = norm_strict) -> DataFrame:
    """``with_edits`` of ``normalised`` pairs, normalising each text once.

    Empty pairs leave after the alignment, which costs them nothing; a filter
    before it would be pushed below the normalising and repeat it.
    """
    ready = _normalised(pairs, normalise).withColumn("_kept", is_scorable())
    return with_edits(ready).where("_kept").drop("_kept")


def with_distance(pairs: DataFrame) -> DataFrame:
    """Add ``ref_words`` and ``edits`` alone."""
    words = [word_tokens(F.col(c)) for c in ("reference", "hypothesis")]
    return pairs.withColumn("ref_words", F.size(words[0]).cast("long")).withColumn("edits", edit_distance(*words))


def _error_rate() -> Column:
    return (F.lit(100.0) * F.sum("edits") / F.sum("ref_words")).alias("wer")


def corpus_wer(scored: DataFrame) -> DataFrame:
    """One row: percent of edits over reference words; null without pairs."""
    return scored.agg(_error_rate())


def corpus_edit_totals(scored: DataFrame) -> DataFrame:
    """One row with the total substitutions, deletions and insertions."""
    return scored.agg(*[F.sum(c).alias(c) for c in ("substitutions", "deletions", "insertions")])


def wer_by_language(scored: DataFrame) -> DataFrame:
    """One row per language, a null one included, and one for the corpus, which ``is_corpus`` marks."""
    return scored.rollup("language").agg(
        (F.grouping("language") == 1).alias("is_corpus"),
        F.count("*").alias("pairs"),
        F.sum("ref_words").alias("ref_words"),
        F.sum("edits").alias("edits"),
        _error_rate(),
    )


def result_rows(pairs: DataFrame, audio: str = "audio_path") -> DataFrame:
    """The result sheet: reference, result and audio file of every scored pair."""
    return pairs.select(
        F.col("reference").alias("Reference"),
        F.col("hypothesis").alias("Result"),
        F.col(audio).alias("Audio_File"),
        "language",
    )
