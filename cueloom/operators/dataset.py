"""Building, splitting and summarising the training dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueloom.constants import MAX_CLIP_SECONDS, MIN_CLIP_SECONDS, SAMPLE_RATE
from cueloom.functions.text import strip_ws, word_tokens
from cueloom.operators.ordering import HASH_DIGITS, hash_order


def build_dataset(
    pairs: DataFrame, media: str, sentence: str, language: Column | str = "language", rate: int = SAMPLE_RATE
) -> DataFrame:
    """``(audio struct<path, sample_rate>, sentence, language)`` with both texts stripped."""
    language = F.col(language) if isinstance(language, str) else language
    return pairs.select(
        F.struct(
            strip_ws(F.col(media)).alias("path"), F.lit(rate).cast("int").alias("sample_rate")
        ).alias("audio"),
        strip_ws(F.col(sentence)).cast("string").alias("sentence"),
        language.cast("string").alias("language"),
    )


def duration_range(
    rows: DataFrame, min_seconds: float = MIN_CLIP_SECONDS, max_seconds: float = MAX_CLIP_SECONDS
) -> DataFrame:
    """Rows strictly inside the duration bounds. Needs no labels: apply it before encoding."""
    seconds = F.col("input_length")
    return rows.where((seconds > min_seconds) & (seconds < max_seconds))


def label_range(rows: DataFrame, max_label_length: int) -> DataFrame:
    """Rows with at least one label and fewer than ``max_label_length``."""
    labels = F.size("labels")
    return rows.where((labels > 0) & (labels < max_label_length))


def length_range(rows: DataFrame, max_label_length: int) -> DataFrame:
    """Rows strictly inside the duration and label length bounds."""
    return label_range(duration_range(rows), max_label_length)


def train_eval_split(rows: DataFrame, key: list[str], train_percent: int, seed: int = 0) -> DataFrame:
    """Add ``split``: a stable hash of the row key sends ``train_percent`` % to ``train``.

    A row keeps its side whatever else is in the table. Shares hold per language
    up to sampling error.
    """
    bucket = F.conv(F.left(hash_order(key, seed), F.lit(8)), 16, 10).cast("long") % 100
    return rows.withColumn("split", F.when(bucket < train_percent, "train").otherwise("eval"))


def exact_split(rows: DataFrame, key: list[str], train_percent: int, seed: int = 0, by: str = "language") -> DataFrame:
    """Add ``split``: of every language exactly ``floor(n * train_percent / 100)`` rows go to ``train``.

    They are the ones of the least hash of the row key, which must identify a
    row; a row without a language belongs to the language null. The cut of each
    language is found without sorting it: counts by the first digits of the hash
    (at most 65,536 a language) say in which bucket the cut lies, and only the
    rows of that bucket, about one in 65,536, are ranked. Rows are then compared
    with the cut of their language and are not shuffled.
    """
    hashed = rows.withColumn("_hash", hash_order(key, seed))
    bucket = F.left("_hash", F.lit(HASH_DIGITS)).alias("_bucket")
    sizes = hashed.groupBy(F.col(by), bucket).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(by)
    target = F.floor(F.sum("_n").over(whole) * train_percent / 100)
    upto = F.sum("_n").over(whole.orderBy("_bucket"))
    cut = sizes.select(by, "_bucket", target.alias("_target"), (upto - F.col("_n")).alias("_before"), upto.alias("_upto"))
    cut = cut.where("_before < _target and _target <= _upto").select(
        F.col(by).alias("_of"), "_bucket", (F.col("_target") - F.col("_before")).alias("_place")
    )
    row = F.struct("_hash", *key)
    keys = hashed.select(by, "_hash", bucket, *key)
    inside = keys.join(F.broadcast(cut), keys[by].eqNullSafe(cut["_of"]) & (keys["_bucket"] == cut["_bucket"]))
    rank = F.row_number().over(Window.partitionBy("_of").orderBy("_hash", *key))
    last = inside.select("_of", "_place", row.alias("_last"), rank.alias("_rank")).where("_rank = _place")
    last = last.select("_of", "_last")
    # A row a language: as many as the summary by language has.
    marked = hashed.join(F.broadcast(last), F.col(by).eqNullSafe(F.col("_of")), "left")
    train = F.coalesce(row <= F.col("_last"), F.lit(False))
    return marked.select(*rows.columns, F.when(train, "train").otherwise("eval").alias("split"))


def language_summary(rows: DataFrame, text: str, seconds: Column) -> DataFrame:
    """Clips, words and seconds of every language in one pass."""
    return rows.groupBy("language").agg(
        F.count("*").alias("clips"),
        F.sum(F.size(word_tokens(F.col(text)))).cast("long").alias("words"),
        F.sum(seconds).alias("seconds"),
    )
