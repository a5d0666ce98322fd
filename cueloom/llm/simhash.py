"""SimHash near-dedup: fingerprints of word shingles, linked by Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cueloom.llm.common import as_bytes, as_list, pieces_of, put_back, set_aside, stored, text_key
from cueloom.llm.components import bucket_links, components

BITS = 64
SHINGLE_SEED = 42
_COUNTED_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle_words: int = 4) -> int:
    """64-bit SimHash of a UTF-8 text: a bit is set if more than half of the shingle hashes set it.

    Words are runs without ASCII white space, A-Z in lower case. A text of fewer
    words than a shingle is one shingle; a text without words has fingerprint 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(shingle_words, len(words))
    first, last = starts[: len(words) - span + 1], ends[span - 1 :]
    ones, total = np.zeros(BITS, np.int64), len(first)
    for at in range(0, total, _COUNTED_AT_ONCE):
        part = slice(at, at + _COUNTED_AT_ONCE)
        hashes = [
            xxh64_intdigest(joined[s:e], SHINGLE_SEED)
            for s, e in zip(first[part].tolist(), last[part].tolist(), strict=True)
        ]
        wide = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(wide, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4, keyed: bool = False) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long), a row for each row of ``docs``.

    ``keyed`` adds ``_key``, the hash of the text (``text_key``), before ``fp``.
    """
    names = ["doc_id", "_key"] if keyed else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            prints = [fingerprint(text, shingle_words) for text in as_bytes(batch, "text")]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64))
            own = [pa.array(as_list(batch, n), pa.int64()) for n in names]
            yield pa.RecordBatch.from_arrays([*own, signed], [*names, "fp"])

    columns = {
        "doc_id": F.col("doc_id").cast("long").alias("doc_id"),
        "_key": text_key().alias("_key"),
    }
    narrow = docs.select(*[columns[n] for n in names], F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "fp"]))


def block_masks(max_bits: int, blocks: int) -> list[int]:
    """Bit masks of which a pair within ``max_bits`` agrees on at least one whole mask.

    The 64 bits are cut into ``blocks`` blocks. Differing bits touch at most
    ``max_bits`` of them, so all combinations of ``blocks - max_bits`` blocks hold
    one without a difference.
    """
    if not 0 <= max_bits < blocks <= BITS:
        raise ValueError("max_bits must be below blocks, and blocks at most 64")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    block = [((1 << (high - low)) - 1) << low for low, high in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, blocks - max_bits)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask).cast("long")


def simhash_groups(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """``doc_id, fp, component_id`` for each row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is
    the smallest doc_id that links lead to. Equal fingerprints are one node, so
    copies meet in an aggregate. Nodes meet on block combinations
    (``block_masks``): with the default, 35 keys of 27 or 28 bits a node, so that
    chance meetings stay few in large tables. Every meeting is decided by
    ``bit_count`` of the exclusive or. Texts without words, null ones included,
    have fingerprint 0. Rows of a null doc_id take part; a component of only such
    rows has a null id. Repeated rows get equal results. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, shingle_words), "fingerprints")
    named = _named(prints, max_bits, blocks)
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _named(prints: DataFrame, max_bits: int, blocks: int, *more: str) -> DataFrame:
    """``fp, component_id`` of every fingerprint of ``prints``; ``more`` can ask for ``root``, which no two components share."""
    nodes = prints.groupBy("fp").agg(F.count("*").alias("weight"), F.min("doc_id").alias("least_id"))
    nodes = stored(nodes, "nodes")
    keys = [
        F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(_signed(m)).alias("bits"))
        for i, m in enumerate(block_masks(max_bits, blocks))
    ]
    members = nodes.select(F.col("fp").alias("node"), "weight", F.explode(F.array(*keys)).alias("key")).select(
        "key.block", "key.bits", "node", "weight"
    )

    def close(pairs: DataFrame) -> DataFrame:
        return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)

    roots = components(bucket_links(members, ["block", "bits"], close))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return stored(rooted.join(named, "root").select("fp", *more, "component_id"), "named")


def fingerprint_hex(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_copies(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """``docs`` with one row of each component of ``simhash_groups``, whatever ids its rows have.

    It is the row of the smallest doc_id, null last, and of these the one of the
    smallest text, then of the smallest other columns. Components that share a
    doc_id, and such as have only null ones, keep a row each.
    """
    prints = stored(fingerprints(docs, shingle_words, keyed=True), "fingerprints")
    named = _named(prints, max_bits, blocks, "root")
    places = prints.join(named, "fp").where("doc_id <=> component_id")
    places = places.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "root").distinct()
    keyed = set_aside(docs).withColumn("_key", text_key())
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_key").eqNullSafe(F.col("_k"))
    first = keyed.join(places, same).groupBy("root").agg(F.min(F.struct("doc_id", "text", "_rest")).alias("_row"))
    return put_back(first.select("_row.doc_id", "_row.text", "_row._rest"), docs.columns)
