"""Manifest rows against storage listings."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueloom.functions.paths import audio_target, manifest_audio_name, path_basename, transcript_kind
from cueloom.functions.python import once
from cueloom.runtime import checkpointed

#: Texts that every worker may hold; names of up to a few dozen characters each.
MAX_LISTED_TEXTS = 1_000_000

#: Bits of the filter that thins path endings before they are shuffled. Every task holds at most a row for 64 of them.
FILTER_BITS = 1 << 26


def manifest_complete(manifest: DataFrame) -> DataFrame:
    """Rows that name both a media and a transcript file."""
    return manifest.dropna(subset=["media_file", "transcript_file"])


def supported_only(manifest: DataFrame) -> DataFrame:
    """Rows whose transcript format can be parsed."""
    return manifest.where(transcript_kind(F.col("transcript_file")) != "unsupported")


def is_excluded(name: Column, emails: list[str] = (), domains: list[str] = ()) -> Column:
    """Whether ``name`` contains any excluded text, wherever it stands."""
    tests = [name.contains(text) for text in (*emails, *domains)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def exclude_names(rows: DataFrame, columns: list[str], emails: list[str] = (), domains: list[str] = ()) -> DataFrame:
    """Drop rows in which any of ``columns`` contains an excluded text."""
    hit = reduce(lambda a, b: a | b, [is_excluded(F.col(c), emails, domains) for c in columns])
    return rows.where(~F.coalesce(hit, F.lit(False)))


class ListedTexts:
    """A list of texts that is searched in one pass over a name.

    The texts are filed by their first characters, up to ``_HEAD`` of them, with
    the lengths that occur under each head. At every place of a name the head is
    looked up, and only under a known one the few lengths. Texts with one head
    cost no more than their lengths, however many they are. The index is built
    where it is first used, once in the life of a worker.
    """

    _HEAD = 4

    def __init__(self, texts: list[str]):
        self.texts, self._index = texts, None

    def _built(self) -> tuple[set[str], list[tuple[int, dict[str, list[int]]]], bool]:
        if self._index is None:
            texts = set(self.texts)
            heads: dict[int, dict[str, set[int]]] = {}
            for text in texts - {""}:
                head = text[: self._HEAD]
                heads.setdefault(len(head), {}).setdefault(head, set()).add(len(text))
            filed = [(size, {h: sorted(n) for h, n in by.items()}) for size, by in sorted(heads.items())]
            self._index = texts, filed, "" in texts
        return self._index

    def found_in(self, name: str | None) -> bool | None:
        """Whether any of the texts stands anywhere in ``name``."""
        if name is None:
            return None
        texts, filed, always = self._built()
        if always:
            return True
        for size, lengths in filed:
            for at in range(len(name) - size + 1):
                for length in lengths.get(name[at : at + size], ()):
                    if name[at : at + length] in texts:
                        return True
        return False


def _listed_texts(texts: DataFrame) -> DataFrame:
    return texts.toDF("text").where("text is not null").distinct()


def contains_listed(rows: DataFrame, column: str, texts: list[str]) -> Column:
    """Whether ``column`` contains any of ``texts``, which every worker holds."""
    shared = rows.sparkSession.sparkContext.broadcast(ListedTexts(texts))

    @once
    @F.arrow_udf(T.BooleanType())
    def search(names: pa.Array) -> pa.Array:
        listed = shared.value
        return pa.array([listed.found_in(name) for name in names.to_pylist()], pa.bool_())

    return search(F.col(column))


def flag_listed(
    rows: DataFrame, columns: list[str], texts: DataFrame, flag: str, max_texts: int = MAX_LISTED_TEXTS
) -> DataFrame:
    """Add ``flag``: whether any of ``columns`` contains any text of a long list; a null contains none.

    ``texts`` has one column; nulls in it are ignored, an empty text stands in
    every name. Up to ``max_texts`` of them go to every worker and each name is
    read once. A longer list stays distributed: every name is cut to pieces of
    each length that a text has, which meet the texts by equality; that costs a
    row for each place and length, so it is meant for lists no worker can hold.
    Both ways give what ``contains`` gives, and keep repeated rows.
    """
    listed = _listed_texts(texts)
    held = listed.limit(max_texts + 1).toArrow()["text"].to_pylist()
    either = lambda hits: reduce(lambda a, b: a | b, hits)
    if len(held) <= max_texts:
        return rows.withColumn(flag, either([F.coalesce(contains_listed(rows, c, held), F.lit(False)) for c in columns]))
    listed = checkpointed(listed)
    lengths = listed.agg(F.collect_set(F.length("text"))).scalar()
    names = reduce(DataFrame.union, [rows.select(F.col(c).alias("name")) for c in columns])
    names = names.where("name is not null").distinct()
    starts = F.filter(F.sequence(F.lit(1), F.length("name") + 1), lambda at: at + F.col("size") <= F.length("name") + 1)
    pieces = (
        names.select("name", F.explode(lengths).alias("size"))
        .where(F.col("size") <= F.length("name"))
        .select("name", "size", F.explode(starts).alias("at"))
        .select("name", F.substring("name", F.col("at"), F.col("size")).alias("text"))
    )
    hits = pieces.distinct().join(listed, "text", "left_semi").select("name").distinct()
    kept = rows.columns
    for i, column in enumerate(columns):
        rows = rows.join(hits.select(F.col("name").alias(column), F.lit(True).alias(f"_hit{i}")), column, "left")
    found = either([F.coalesce(f"_hit{i}", F.lit(False)) for i in range(len(columns))])
    return rows.select(*kept, found.alias(flag))


def exclude_listed(
    rows: DataFrame, columns: list[str], texts: DataFrame, max_texts: int = MAX_LISTED_TEXTS
) -> DataFrame:
    """Drop rows in which any of ``columns`` contains any text of a long list, as ``flag_listed`` finds them."""
    return flag_listed(rows, columns, texts, "_listed", max_texts).where("not _listed").drop("_listed")


def _bit_of(name: str, bits: int) -> Column:
    """The bit of a name in the filter: the same for a name and for the ending of a path that equals it."""
    return F.pmod(F.xxhash64(name), F.lit(bits))


def name_filter(names: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``word, mask``: a Bloom filter of ``names`` (name) as a table, 64 bits a row.

    It has at most ``bits / 64`` rows however many names there are; more names
    only let more of other texts pass.
    """
    placed = names.select(_bit_of("name", bits).alias("_bit"))
    mask = F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))"))
    return placed.groupBy(F.expr("_bit div 64").alias("word")).agg(mask.alias("mask"))


def path_endings(names: DataFrame, listing: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``(path, name)``: endings of listed paths that the filter of ``names`` lets pass; all true ones do.

    Each path is cut to its last ``k`` characters for every length ``k`` a name
    has. The lengths are a scalar subquery and never exceed the longest path.
    Endings are tested where the path is read, so what matches no name is not shuffled.
    """
    lengths = names.agg(F.collect_set(F.length("name"))).scalar()
    cuts = (
        listing.select("path", F.explode(lengths).alias("k"))
        .where(F.col("k") <= F.length("path"))
        .select("path", F.right("path", F.col("k")).alias("name"))
        .withColumn("_bit", _bit_of("name", bits))
        .withColumn("word", F.expr("_bit div 64"))
    )
    shared = F.broadcast(name_filter(names, bits))  # at most bits / 64 rows
    passed = cuts.join(shared, "word").where("mask & shiftleft(1L, cast(_bit % 64 as int)) != 0")
    return passed.select("path", "name")


def _resolved(names: DataFrame, listing: DataFrame, bits: int) -> DataFrame:
    """``(name, path)``: the smallest listed path that ends with each name.

    "Ends with" is turned into equality with the endings that pass the filter of
    names. They are aggregated before they meet the names, so an ending that a
    third of the objects share costs one row per map task. One plan for lists of
    any length, and no job before it runs.
    """
    endings = path_endings(names, listing, bits)
    return endings.groupBy("name").agg(F.min("path").alias("path")).join(names, "name", "left_semi")


def _looked_up(manifest: DataFrame, best: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Left join each name column to ``(name, path)``; one path per name, so no row multiplies."""
    out = manifest
    for column, new in columns.items():
        out = out.join(best.select(F.col("name").alias(column), F.col("path").alias(new)), column, "left")
    return out.select(*manifest.columns, *columns.values())


def resolve_names(
    manifest: DataFrame,
    listing: DataFrame,
    columns: dict[str, str],
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Add, for each ``{name column: new column}``, the listed path ending with the name.

    The smallest such path is taken; without one the new column is null. All
    columns are resolved in one pass over the listing. ``filter_bits`` bounds what
    every task holds of the names; the result does not depend on it.
    """
    names = reduce(DataFrame.union, [manifest.select(F.col(c).alias("name")) for c in columns])
    names = names.where("name is not null").distinct()
    return _looked_up(manifest, _resolved(names, listing, filter_bits), columns)


def resolve_exact(manifest: DataFrame, listing: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Like ``resolve_names`` with equality on the basename: ``ba.wav`` is no ``a.wav``."""
    best = (
        listing.select(path_basename(F.col("path")).alias("name"), "path")
        .groupBy("name")
        .agg(F.min("path").alias("path"))
    )
    return _looked_up(manifest, best, columns)


def listed_names(listing: DataFrame, name: str) -> DataFrame:
    """Distinct basenames of a listing, as column ``name``."""
    return listing.select(path_basename(F.col("path")).alias(name)).distinct()


def skip_present(resolved: DataFrame, present: DataFrame, path: str = "media_path") -> DataFrame:
    """Drop rows whose audio file is listed in ``present``."""
    return (
        resolved.withColumn("_target", audio_target(F.col(path)))
        .join(listed_names(present, "_target"), "_target", "left_anti")
        .drop("_target")
    )


def both_files_exist(manifest: DataFrame, audio: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Rows whose audio and transcript are both listed."""
    return (
        manifest.withColumn("_audio", manifest_audio_name(F.col("media_file")))
        .join(listed_names(audio, "_audio"), "_audio", "left_semi")
        .join(listed_names(transcripts, "transcript_file"), "transcript_file", "left_semi")
        .select(*manifest.columns)
    )
