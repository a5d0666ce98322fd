"""Scoring runs from audio or from label ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueloom.functions.text import norm_basic, norm_strict
from cueloom.operators.batchmap import map_batches
from cueloom.operators.labels import unmask_labels, word_decoder
from cueloom.operators.pairs import audio_exists
from cueloom.operators.scoring import Normaliser, corpus_wer, score


def transcribe(
    pairs: DataFrame, listing: DataFrame, transcriber, audio: str = "audio_path", partitions: int | None = None
) -> DataFrame:
    """Pairs whose audio exists, with ``hypothesis`` from the transcriber.

    ``transcriber()`` runs once per task and returns a function from a batch to
    the batch with ``hypothesis`` added. Missing audio is dropped before it.
    """
    present = audio_exists(pairs, listing, audio)
    schema = T.StructType([*present.schema.fields, T.StructField("hypothesis", T.StringType())])
    return map_batches(present, transcriber, schema, partitions)


def transcribe_and_score(
    pairs: DataFrame,
    listing: DataFrame,
    transcriber,
    normalise: Normaliser = norm_strict,
    partitions: int | None = None,
) -> DataFrame:
    """Transcribe, normalise, drop empty pairs and count edits by kind."""
    return score(transcribe(pairs, listing, transcriber, partitions=partitions), normalise)


def train_metric_wer(predictions: DataFrame, vocab: DataFrame, compose: bool = False) -> DataFrame:
    """Corpus error rate of ``predicted`` against masked ``labels``.

    Unmasks, decodes, normalises as in training, drops blank pairs. A vocabulary
    of normalised words decodes to composed text, hence ``compose=False``.
    """
    decode = word_decoder(vocab)
    pairs = predictions.select(
        decode(unmask_labels(F.col("labels"))).alias("reference"),
        decode(F.col("predicted")).alias("hypothesis"),
    )
    return corpus_wer(score(pairs, lambda text: norm_basic(text, compose)))
