"""Word labels and padded training batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueloom.constants import (
    BATCH_SIZE,
    BOS_ID,
    EOS_ID,
    FIRST_WORD_ID,
    IGNORED_LABEL,
    PAD_ID,
    SHUFFLE_SEED,
    UNKNOWN_ID,
)
from cueloom.functions.python import once
from cueloom.operators.ordering import seeded_shuffle, with_position
from cueloom.runtime import checkpointed

# A vocabulary is shipped to every Python worker, so its size is bounded.
MAX_VOCABULARY = 1_000_000


def _count_bin() -> Column:
    """Sixteen bins to each doubling of a count; small counts have one each."""
    return F.floor(F.log2("n") * 16).cast("int")


def _cut_off(counts: DataFrame, size: int) -> tuple[int, int] | None:
    """The least count among the ``size`` most frequent words, and how many of that count belong to them.

    None if all words do. A histogram of counts by bins, of at most a thousand
    rows, says in which bin the cut lies; the counts in that bin are then told
    apart, of which there are no more than it has words.
    """
    bins = counts.groupBy(_count_bin().alias("bin")).agg(F.count("*").alias("words"))
    left = size
    for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
        if left < row["words"]:
            break
        left -= row["words"]
    else:
        return None
    exact = counts.where(_count_bin() == row["bin"]).groupBy("n").agg(F.count("*").alias("words"))
    running = F.sum("words").over(Window.orderBy(F.desc("n")))
    least = exact.withColumn("upto", running).where(F.col("upto") > left).orderBy(F.desc("n")).first()
    return least["n"], left - (least["upto"] - least["words"])


def build_vocab(rows: DataFrame, words: Column, size: int) -> DataFrame:
    """``(word, n, id)`` of the ``size`` most frequent words.

    Ids rise from ``FIRST_WORD_ID`` by falling count, then by word. Words are
    counted once, and the counts checkpointed. A histogram of counts gives the
    count at which the list ends, so only words beyond it, fewer than ``size``,
    are ranked in one place. Those of just that count, which may be most of all
    words, are numbered by ranges of words, and the first ones fill the list.
    Checkpoint or save the result if it is used more than once.
    """
    if not 0 < size <= MAX_VOCABULARY:
        raise ValueError(f"vocabulary size must be in 1..{MAX_VOCABULARY}")
    counts = rows.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    top = counts = checkpointed(counts)
    cut = _cut_off(counts, size)
    if cut:
        least, missing = cut
        top = counts.where(F.col("n") > least)
        if missing:
            ties = with_position(counts.where(F.col("n") == least), ["word"], "n").where(F.col("position") < missing)
            top = top.union(ties.select("word", "n"))
    rank = F.row_number().over(Window.orderBy(F.desc("n"), F.asc("word")))
    return top.select("word", "n", (rank + (FIRST_WORD_ID - 1)).cast("long").alias("id"))


def _collected_words(vocab: DataFrame) -> pa.Array:
    """Words in id order; the vocabulary's size bound makes this safe."""
    words = vocab.orderBy("id").limit(MAX_VOCABULARY + 1).select("word").toArrow()["word"].combine_chunks()
    if len(words) > MAX_VOCABULARY:
        raise ValueError(f"vocabulary has more than {MAX_VOCABULARY} words")
    return words


class _WordIds:
    """Place of each word of a vocabulary; the table is built once in the life of a worker."""

    def __init__(self, words: pa.Array):
        self.words, self._places = words, None

    def places(self, words: list[str | None]) -> np.ndarray:
        """Place of each word, -1 for others."""
        if self._places is None:
            self._places = {word: i for i, word in enumerate(self.words.to_pylist())}
        return np.fromiter((self._places.get(word, -1) for word in words), np.int64, len(words))


def word_encoder(vocab: DataFrame) -> Callable[[Column], Column]:
    """Column function from words to label ids.

    One lookup per distinct word of a batch, with no shuffle. The alternative,
    exploding, joining and regrouping, would shuffle every word of the corpus.
    """
    shared = vocab.sparkSession.sparkContext.broadcast(_WordIds(_collected_words(vocab)))

    @once
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(words: pa.Array) -> pa.Array:
        coded = words.flatten().dictionary_encode()
        place = shared.value.places(coded.dictionary.to_pylist())
        known = np.append(np.where(place >= 0, place + FIRST_WORD_ID, UNKNOWN_ID), UNKNOWN_ID).astype(np.int32)
        # A null word is unknown: it takes the entry after the last.
        ids = pa.array(known[coded.indices.fill_null(len(place)).to_numpy(zero_copy_only=False)])
        sizes = pc.fill_null(pc.list_value_length(words), 0)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), ids)

    return encode


def word_decoder(vocab: DataFrame) -> Callable[[Column], Column]:
    """Column function from label ids to text; ids that are no word are dropped."""
    shared = vocab.sparkSession.sparkContext.broadcast(_collected_words(vocab))

    @once
    @F.arrow_udf(T.StringType())
    def decode(labels: pa.Array) -> pa.Array:
        words = shared.value
        place = np.asarray(labels.flatten()).astype(np.int64) - FIRST_WORD_ID
        parent = np.asarray(pc.list_parent_indices(labels))
        known = (place >= 0) & (place < len(words))
        sizes = np.bincount(parent[known], minlength=len(labels))
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words.take(pa.array(place[known]))), " ")

    return decode


def language_prefix(language: Column, languages: list[str], vocab_size: int) -> Column:
    """Label prefix: begin, language and task token.

    Language tokens follow the vocabulary in the order given; the task token
    follows them. An unknown language gets the unknown id.
    """
    base = FIRST_WORD_ID + vocab_size
    token = F.lit(UNKNOWN_ID)
    for number, name in enumerate(languages):
        token = F.when(language == name, base + number).otherwise(token)
    return F.array(F.lit(BOS_ID), token, F.lit(base + len(languages)))


def encode_labels(rows: DataFrame, words: Column, vocab: DataFrame, prefix: Column | None = None) -> DataFrame:
    """Add ``labels``: prefix, one id per word, end token."""
    prefix = F.array(F.lit(BOS_ID)) if prefix is None else prefix
    return rows.withColumn("labels", F.concat(prefix, word_encoder(vocab)(words), F.array(F.lit(EOS_ID))))


def decode_labels(rows: DataFrame, vocab: DataFrame, labels: str = "labels", into: str = "text") -> DataFrame:
    """Add the text of the labels, special tokens dropped."""
    return rows.withColumn(into, word_decoder(vocab)(F.col(labels)))


def assign_batches(
    rows: DataFrame, key: list[str], size: int = BATCH_SIZE, seed: int = SHUFFLE_SEED, by: list[str] = ()
) -> DataFrame:
    """Shuffle rows and add ``batch_id`` and ``row_in_batch``; only the last batch may be short.

    ``by``, such as ``["split"]``, names groups that are shuffled and batched apart,
    each from batch 0.
    """
    return (
        seeded_shuffle(rows, key, seed, by)
        .withColumn("batch_id", F.expr(f"position div {size}"))
        .withColumn("row_in_batch", F.col("position") % size)
        .drop("position")
    )


def _over_batch(value: Column, by: list[str]) -> Column:
    return value.over(Window.partitionBy(*by, "batch_id"))


def pad_batches(rows: DataFrame, filler: int = IGNORED_LABEL, by: list[str] = ()) -> DataFrame:
    """Labels padded to the longest of their batch."""
    missing = _over_batch(F.max(F.size("labels")), by) - F.size("labels")
    return rows.withColumn("labels", F.concat("labels", F.array_repeat(F.lit(filler), missing)))


def strip_bos(rows: DataFrame, bos: int = BOS_ID, by: list[str] = ()) -> DataFrame:
    """Drop the first label of a batch if every row of it begins with ``bos``."""
    begins = F.coalesce(F.get("labels", F.lit(0)) == bos, F.lit(False))
    rest = F.slice("labels", F.lit(2), F.size("labels"))
    return (
        rows.withColumn("_all", _over_batch(F.bool_and(begins), by))
        .withColumn("labels", F.when(F.col("_all"), rest).otherwise(F.col("labels")))
        .drop("_all")
    )


def unmask_labels(labels: Column, pad: int = PAD_ID) -> Column:
    """Ignored cells back to the padding id, as decoding needs."""
    return F.transform(labels, lambda x: F.when(x == IGNORED_LABEL, pad).otherwise(x))
