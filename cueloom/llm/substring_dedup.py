"""Removal of long repeated strings: a cover of sampled suffixes names every long match.

A string of ``length`` bytes that occurs twice contains, at one and the same place
in both, a sampled position. Sampled positions are named by the bytes that follow;
names that occur once are dropped. Where whole neighbourhoods of equal names agree,
all strings in them repeat. What is left, the strings near the ends of matches, is
named one by one and compared with its equals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cueloom.llm.common import as_bytes, as_list, pieces_of, stored, text_key

LENGTH = 400
_DOC = ["doc", "key"]
_NO_ID = -(2**63)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    values = (left ^ (left >> np.uint64(31))) * _MIX + right
    return (values ^ (values >> np.uint64(29))) * _ODD


class Hashes:
    """Hashes of the strings of a fixed length at all places of a text, by doubling."""

    def __init__(self, text: bytes):
        values = (np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * _ODD
        self._powers = [values ^ (values >> np.uint64(32))]

    def of(self, length: int) -> np.ndarray:
        level = length.bit_length() - 1
        while len(self._powers) <= level:
            last, step = self._powers[-1], 1 << (len(self._powers) - 1)
            self._powers.append(_paired(last[:-step], last[step:]))
        whole = self._powers[level]
        rest = length - (1 << level)
        return _paired(whole[: len(whole) - rest], whole[rest:]) if rest else whole

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each string from start to end (longer than 0): its two overlapping powers and its length."""
        lengths = ends - starts
        levels = np.floor(np.log2(lengths)).astype(np.int64)
        out = np.zeros(len(starts), np.uint64)
        for level in np.unique(levels).tolist():
            self.of(1 << level)
            own, power = levels == level, self._powers[level]
            pair = _paired(power[starts[own]], power[ends[own] - (1 << level)])
            out[own] = _paired(pair, lengths[own].astype(np.uint64))
        return out


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """A period and residues such that every difference modulo the period occurs among the residues.

    The Colbourn-Ling cover: period 24r^2 + 36r + 13 with 6r + 4 residues.
    """
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.cumsum([0, *steps])


def difference_places(hashes: Hashes, size: int, length: int, r: int = 2) -> tuple[np.ndarray, ...]:
    """Places in a difference cover: place, first and last start it serves, name.

    Two starts of equal strings differ by some amount modulo the period; the cover
    holds two residues with that difference, so within a period both meet a place
    at equal distance. Every place serves all starts up to a period before it.
    """
    period, residues = difference_cover(r)
    name = length - period + 1
    at = (np.arange(0, size, period)[:, None] + residues[None, :]).ravel()
    at = at[at <= size - name]
    low, high = np.maximum(0, at - (period - 1)), np.minimum(at, size - length)
    served = low <= high
    return at[served], low[served], high[served], hashes.of(name)[at[served]]


def minimum_places(hashes: Hashes, size: int, length: int, r: int = 2) -> tuple[np.ndarray, ...]:
    """Places that the text itself chooses: the first one of the least name in a string.

    Equal strings choose alike, so each start needs one place only. Same result
    columns and name length as ``difference_places``; the served starts do not overlap.
    """
    period, _ = difference_cover(r)
    names = hashes.of(length - period + 1)
    least, place, width = names, np.arange(len(names)), 1
    while width < period:
        step = min(width, period - width)
        left, right = least[:-step], least[step:]
        place = np.where(left <= right, place[:-step], place[step:])
        least = np.minimum(left, right)
        width += step
    low = np.flatnonzero(np.diff(place, prepend=-1))
    high = np.append(low[1:], len(place)) - 1
    at = place[low]
    return at, low, high, names[at]


COVERS = {"difference": difference_places, "minimum": minimum_places}
_SEGMENT = 1 << 20


def _segments(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """Parts of a text such that each string of ``length`` starts in exactly one. Bounds memory."""
    for at in range(0, max(0, len(text) - length + 1), _SEGMENT):
        yield at, text[at : at + _SEGMENT + length - 1]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _batch(names: list[str], columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names)


def _places(base: DataFrame, length: int, cover: str) -> DataFrame:
    """``name, context, doc, key, low, high``: every sampled place and the hash of all it serves."""
    names = ["name", "context", "doc", "key", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 128):
            columns: list[list[np.ndarray]] = [[] for _ in names]
            for doc, key, text in zip(as_list(batch, "doc"), as_list(batch, "key"), as_bytes(batch, "text"), strict=True):
                for start, part in _segments(text or b"", length):
                    hashes = Hashes(part)
                    at, low, high, name = COVERS[cover](hashes, len(part), length)
                    context = _paired(hashes.between(low, high + length), (at - low).astype(np.uint64))
                    whose = [np.full(len(at), x, np.int64) for x in (doc, key)]
                    found = [_signed(name), _signed(context), *whose, low + start, high + start]
                    for column, values in zip(columns, found, strict=True):
                        column.append(values)
            yield _batch(names, columns)

    return base.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _strings(asked: DataFrame, length: int) -> DataFrame:
    """``name, string, doc, key, at, weight``: the hash of each string that starts in a text's ``parts``."""
    names = ["name", "string", "doc", "key", "at", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 64):
            columns: list[list[np.ndarray]] = [[] for _ in names]
            ids = (as_list(batch, c) for c in ("doc", "key"))
            for doc, key, text, parts in zip(*ids, as_bytes(batch, "text"), as_list(batch, "parts"), strict=True):
                for start, part in _segments(text, length):
                    count = len(part) - length + 1
                    name, weight = np.zeros(count, np.int64), np.zeros(count, np.int64)
                    for p in parts:
                        own = slice(max(0, p["low"] - start), max(0, p["high"] + 1 - start))
                        name[own] = p["name"]
                        weight[own] = np.maximum(weight[own], p["weight"])
                    at = np.flatnonzero(weight)
                    if len(at):
                        string = Hashes(part).of(length)[at]
                        whose = [np.full(len(at), x, np.int64) for x in (doc, key)]
                        found = [name[at], _signed(string), *whose, at + start, weight[at]]
                        for column, values in zip(columns, found, strict=True):
                            column.append(values)
            yield _batch(names, columns)

    return asked.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def repeated_starts(base: DataFrame, length: int = LENGTH, cover: str = "minimum") -> DataFrame:
    """``doc, key, low, high``: ranges of starts of strings of ``length`` bytes that occur elsewhere too.

    ``base`` has ``doc, key, text``; rows of equal ``doc`` and ``key`` have equal
    texts, repeat each other and share their ranges. Ranges may overlap.
    """
    places = stored(_places(base.select(*_DOC, "text"), length, cover), "places")
    contexts = places.groupBy("name", "context").agg(F.count("*").alias("same"))
    contexts = stored(contexts, "contexts")
    named = contexts.groupBy("name").agg(F.sum("same").alias("all"), F.min("same").alias("least"))
    named = stored(named.where("all > 1").select("name", (F.col("least") == 1).alias("open")), "names")
    met = stored(places.join(named, "name"), "met-places")
    twice = stored(contexts.where("same > 1").join(named, "name", "left_semi"), "twice")
    met = met.join(twice, ["name", "context"], "left").select(*_DOC, "name", "context", "low", "high", "open", "same")
    met = stored(met, "judged-places")
    sure = met.where("same > 1").select(*_DOC, "low", "high")
    # A neighbourhood that repeats speaks once for all its copies.
    one = met.where("open and same > 1").groupBy("name", "context").agg(F.min(F.struct(*_DOC, "low", "high")).alias("p"))
    asked = met.where("open and same is null").select(*_DOC, "low", "high", "name", F.lit(1).alias("weight")).unionByName(
        one.select("p.doc", "p.key", "p.low", "p.high", "name", F.lit(2).alias("weight"))
    )
    if cover == "difference":  # a start has many places there, so its string alone names it
        asked = asked.withColumn("name", F.lit(0).cast("long"))
    asked = asked.groupBy(*_DOC).agg(F.collect_list(F.struct("low", "high", "name", "weight")).alias("parts"))  # of one text
    strings = _strings(base.select(*_DOC, "text").join(asked, _DOC), length)
    equal = Window.partitionBy("name", "string")
    again = strings.withColumn("_all", F.sum("weight").over(equal)).where("weight = 1 and _all > 1")
    return stored(sure.unionByName(again.select(*_DOC, F.col("at").alias("low"), F.col("at").alias("high"))), "starts")


def covered(size: int, lows: np.ndarray, highs: np.ndarray, length: int) -> np.ndarray:
    """Whether each byte is inside a string that starts in one of the ranges."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, lows, 1)
    np.add.at(edges, highs + length, -1)
    return np.cumsum(edges[:-1]) > 0


def remove_repeats(docs: DataFrame, length: int = LENGTH, cover: str = "minimum") -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for each row of ``docs``: its bytes outside repeated strings.

    Each byte covered by a string of ``length`` bytes that also starts anywhere
    else, in the same or another row, is removed; strings are judged on the input
    and never cross rows. ``spans`` are the maximal removed byte ranges as
    ``(start, end)``, ``kept`` the remaining bytes. Null and empty texts have no
    bytes. Rows are told apart by id and text; repeated ids, null ids and repeated
    rows are rows like any other: equal rows of enough bytes remove each other. Other columns are ignored.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = narrow.withColumn("doc", F.coalesce("doc_id", F.lit(_NO_ID))).withColumn("key", text_key())
    ranges = repeated_starts(base, length, cover)
    ranges = ranges.groupBy(*_DOC).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))  # of one text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 128):
            sizes, spans, kept = [], [], []
            for text, found in zip(as_bytes(batch, "text"), as_list(batch, "ranges"), strict=True):
                text = text or b""
                sizes.append(len(text))
                if not found:
                    spans.append([])
                    kept.append(text)
                    continue
                low, high = (np.array([r[k] for r in found], np.int64) for k in ("low", "high"))
                gone = covered(len(text), low, high, length)
                edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
                starts, ends = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
                spans.append([{"start": a, "end": b} for a, b in zip(starts, ends, strict=True)])
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [pa.array(as_list(batch, "doc_id"), pa.int64()), pa.array(sizes, pa.int64())]
            arrays += [pa.array(spans, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "spans", "kept"])

    joined = base.join(ranges, _DOC, "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
