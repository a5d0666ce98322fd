"""Best-fit packing by minimum bin slack over token counts."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cueloom.llm.common import as_list, pieces_of, stored

CAPACITY = 1024
END_ID = 2
_BUCKETS = 1024
_CACHED_CHUNKS = 1_000_000
#: Fixed value: how byte-level BPE of this family splits a text before merging.
_PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_letter() -> dict[str, int]:
    """The letters in which a byte-level vocabulary spells bytes: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in set(own)]
    return {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(others)}


def _quick_encoding(path: str):
    """The same byte-level BPE in tiktoken, several times faster on new words; None for a file of another kind.

    Merging by rank and by order of the merge list are the same if ids rise along the list.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        about = json.load(file)
    model, before = about["model"], about.get("pre_tokenizer") or {}
    odd = ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "byte_fallback", "ignore_merges")
    level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if model["type"] != "BPE" or about.get("normalizer") or not level or any(model.get(x) for x in odd):
        return None
    letters, special = _byte_of_letter(), {x["content"] for x in about["added_tokens"]}
    vocabulary = {k: v for k, v in model["vocab"].items() if k not in special}
    merged = [vocabulary["".join(x if isinstance(x, list) else x.split(" "))] for x in model["merges"]]
    if merged != sorted(merged) or len(merged) + 256 != len(vocabulary):
        return None
    ranks = {bytes(letters[x] for x in word): number for word, number in vocabulary.items()}
    return tiktoken.Encoding("byte-level", pat_str=_PRETOKENS, mergeable_ranks=ranks, special_tokens={})


class TokenCache:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    Texts are cut before each space that follows something else than white space;
    a byte-level BPE token never spans such a place, so chunks are encoded once and
    remembered. A batch is split, looked up and put together as arrays; only chunks
    that are new are encoded one by one. Texts with white space before a space, or
    with one of the tokenizer's own added tokens, are encoded whole, and so are all
    texts if ``whole``.
    """

    def __init__(self, path: str, whole: bool = False):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._quick = None if whole else _quick_encoding(path)
        self._whole = whole
        self._added = [x.content for x in self._tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self._known = pa.array([], pa.large_string())
        self._starts, self._lengths, self._pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded_chunks(self, chunks: list[str]) -> list[list[int]]:
        return list(map(self._quick.encode_ordinary, chunks)) if self._quick else self._encoded(chunks)

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """A number for each of the (different) words, by which the ids of a space and the word are found."""
        places = pc.index_in(words, self._known)
        if places.null_count:
            new = words.filter(pc.is_null(places))
            found = self._encoded_chunks([" " + x for x in new.to_pylist()])
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            numbers = pa.array(np.arange(len(new), dtype=np.int32) + np.int32(len(self._known)))
            places = pc.replace_with_mask(places, pc.is_null(places), numbers)
            self._known = pa.concat_arrays([self._known, new])
            self._starts = np.concatenate([self._starts, len(self._pool) + np.cumsum(lengths) - lengths])
            self._lengths = np.concatenate([self._lengths, lengths])
            ids = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
            self._pool = np.concatenate([self._pool, ids])
        return places.to_numpy(zero_copy_only=False)

    def _joined(self, texts: list[str]) -> list[bytes]:
        if len(self._known) > _CACHED_CHUNKS:
            self._forget()
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        # A text's first word has no space before it; the others go through the cache.
        starts = words.offsets.to_numpy()
        later = np.ones(len(words.values), bool)
        later[starts[:-1]] = False
        firsts = self._encoded_chunks(words.values.take(words.offsets[:-1]).to_pylist())
        coded = words.values.filter(pa.array(later)).dictionary_encode()
        at = self._numbers(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self._lengths[at]
        ends = np.cumsum(lengths)
        ids = self._pool[np.repeat(self._starts[at] - ends + lengths, lengths) + np.arange(lengths.sum())].astype("<u4")
        upto = np.concatenate([[0], ends])[starts - np.arange(len(starts))].tolist()
        rest = zip(firsts, upto, upto[1:], strict=False)
        return [np.array(first, "<u4").tobytes() + ids[a:b].tobytes() for first, a, b in rest]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [not self._whole and _plain(x) and not any(s in x for s in self._added) for x in texts]
        joined = iter(self._joined([x for x, p in zip(texts, plain, strict=True) if p]) if any(plain) else [])
        whole = iter(self._encoded([x for x, p in zip(texts, plain, strict=True) if not p]))
        return [next(joined) if p else np.array(next(whole), "<u4").tobytes() for p in plain]


_RARE_SPACES = [chr(i) + " " for i in [*range(0x1C, 0x20), *range(128, 0x3001)] if chr(i).isspace()]
_COMMON_SPACES = ("  ", "\n ", "\t ", "\r ", "\v ", "\f ")


def _plain(text: str) -> bool:
    """Whether each space follows something else than white space."""
    if text.startswith(" ") or any(x in text for x in _COMMON_SPACES):
        return False
    return text.isascii() or not any(x in text for x in _RARE_SPACES)


@lru_cache(maxsize=4)
def _cache(path: str) -> TokenCache:
    return TokenCache(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids``: every document's ids, ``end_id`` last, cut only if above ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers, ready to be written. All
    pieces but a document's first have ``capacity`` ids. Null and empty texts are
    the end id alone. Control strings in a text are read as the tokenizer reads
    them. ``tokenizer_path`` is a file that every executor has. Repeated rows give
    repeated pieces.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _cache(tokenizer_path)
        for batch in pieces_of(batches, 1024):
            rows = []
            found = encoder.encode([x or "" for x in as_list(batch, "text")])
            for doc_id, ids in zip(as_list(batch, "doc_id"), found, strict=True):
                ids += end
                total, start = len(ids) // 4, 0
                upto = total % capacity or capacity
                piece = 0
                while start < total:
                    rows.append((doc_id, piece, start, upto - start, ids[start * 4 : upto * 4]))
                    piece, start, upto = piece + 1, upto, upto + capacity
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, each at most as often as counted, with the largest sum up to ``room``.

    Subset sums as bits of one integer. Long lengths go first; each joins in
    binary portions, so a length costs the logarithm of its count. Stops as soon
    as the room can be filled. The portions taken are found by walking back.
    """
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, portion = min(counts[length], room // length), 1
        while left > 0:
            portion = min(portion, left)
            steps.append((length, portion, reach))
            reach |= reach << (length * portion) & mask
            left, portion = left - portion, portion * 2
        if reach >> room & 1:
            break
    at, taken = reach.bit_length() - 1, []
    for length, portion, before in reversed(steps):
        if not before >> at & 1:
            at -= length * portion
            taken += [length] * portion
    return taken


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Minimum bin slack: bins as ``(lengths, how many bins alike)``, in order.

    The longest length left opens a bin; ``fullest`` fills the rest. The
    combination is removed as often as the counts allow at once. Each step brings
    a length's count below its number in a bin, so there are at most
    ``sum(capacity // length)`` steps, however many documents there are.
    """
    left, bins = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        lengths = [longest, *fullest({n: c for n, c in rest.items() if c}, capacity - longest)]
        need = {n: lengths.count(n) for n in set(lengths)}
        times = min(left[n] // k for n, k in need.items())
        bins.append((lengths, times))
        for n, k in need.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return bins


def _slots(bins: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, pieces a bin, first sequence and offset of each run of its places."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, times in bins:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            k = lengths.count(n)
            runs.setdefault(n, []).append((used.get(n, 0), k, sequence, offset))
            used[n] = used.get(n, 0) + k * times
            offset += n * k
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for n, r in runs.items()}


#: Columns that packing adds on its way.
_OWN = ("_bucket", "_n", "_start", "_rank")


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (doc_id, piece, length from 1 to ``capacity``).

    Only the counts of the at most ``capacity`` lengths are gathered; bins are
    planned from them. Pieces of a length take its places by rank: hash buckets
    get their start from their counts, and rows are ranked inside a bucket, so a
    frequent length spreads over many tasks. Places in a sequence are gapless from 0.
    All other columns are kept; such as are named like the two added are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    hidden = {name: f"_piece{name}" for name in pieces.columns if name in _OWN}
    pieces = pieces.withColumnsRenamed(hidden)
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(_BUCKETS))
    keyed = stored(pieces.withColumn("_bucket", bucket), "pieces")
    sizes = stored(keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n")), "sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = keyed.sparkSession.sparkContext.broadcast(_slots(plan_bins(counts, capacity)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "starts")
    names = pieces.columns
    others = [c for c in names if c not in ("doc_id", "piece", "length")]
    rank = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", *others))
    ranked = keyed.join(starts, ["length", "_bucket"]).withColumn("_rank", F.col("_start") + rank - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("_rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths).tolist():
                own = lengths == n
                first, each, start, place = slots.value[n]
                run_no = np.searchsorted(first, ranks[own], side="right") - 1
                within = ranks[own] - first[run_no]
                sequence[own] = start[run_no] + within // each[run_no]
                offset[own] = place[run_no] + within % each[run_no] * n
            columns = [*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    chosen = ranked.select(*names, "_rank")
    packed = chosen.mapInArrow(run, f"{schema}, sequence_id long, offset long")
    return packed.withColumnsRenamed({inner: name for name, inner in hidden.items()})


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents in as few sequences as minimum bin slack finds: pieces with ids, sequence and offset.

    See ``token_pieces`` and ``assign_sequences``. An empty table gives no pieces.
    """
    return assign_sequences(token_pieces(docs, tokenizer_path, capacity, end_id), capacity)
