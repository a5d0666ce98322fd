"""From a dataset to padded label batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueloom.constants import BATCH_SIZE, SHUFFLE_SEED
from cueloom.functions.text import norm_basic, word_tokens
from cueloom.operators.dataset import duration_range, label_range
from cueloom.operators.labels import assign_batches, encode_labels, language_prefix, pad_batches, strip_bos


def labelled(
    rows: DataFrame, vocab: DataFrame, vocab_size: int, languages: list[str], compose: bool = True
) -> DataFrame:
    """Add ``labels`` to rows with ``sentence`` and ``language``."""
    words = word_tokens(norm_basic(F.col("sentence"), compose))
    return encode_labels(rows, words, vocab, language_prefix(F.col("language"), languages, vocab_size))


def labels_in_range(
    rows: DataFrame, vocab: DataFrame, vocab_size: int, languages: list[str], max_label_length: int
) -> DataFrame:
    """``length_range`` over labels yet to be made: only clips of fitting duration are encoded."""
    return label_range(labelled(duration_range(rows), vocab, vocab_size, languages), max_label_length)


def training_batches(
    labels: DataFrame, key: list[str], size: int = BATCH_SIZE, seed: int = SHUFFLE_SEED, by: list[str] = ()
) -> DataFrame:
    """Seeded batches, padded, with the shared begin token cut; those of each ``by`` group, such as a split, apart."""
    return strip_bos(pad_batches(assign_batches(labels, key, size, seed, by), by=by), by=by)
