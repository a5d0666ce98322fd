"""Hard-negative mining: exact top inner products inside score windows, by packed R-trees over tiles of the vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueloom.llm.box_tree import LEAF, BoxTree, box_bounds, tile_order
from cueloom.llm.common import stored
from cueloom.llm.vectors import has_finite, scaled

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least this percentage of the positive, and no more than it.
LEAST_PERCENT, MOST_PERCENT = 80, 100

#: Rows of a tile, unless there would be more than MAX_TILES of them. The boxes of
#: all tiles are broadcast, so their number is bounded; larger tables get larger tiles.
TILE_ROWS = 32_768
MAX_TILES = 16_384

_LAST_ID = np.iinfo(np.int64).max
_LOWEST, _HIGHEST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max


def labelled_vectors(table: DataFrame, vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """``vec_id, label, q, copies`` of the rows that take part, equal rows as one.

    Rows with a null label, a null vector, or a null or non-finite component are
    left out. ``q`` is ``floor(256 * x)``. A row without an id takes part, last
    among ties, but is no anchor. Other columns go.
    """
    label = F.col("label") if label is None else label
    rows = table.where(F.col("label").isNotNull() & has_finite(vector)).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), scaled(vector, SCALE).alias("q")
    )
    # Copies meet in partial sums, however many there are.
    return rows.groupBy("vec_id", "label", "q").agg(F.count("*").alias("copies"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of integers as rows of a matrix; shorter ones end in zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int32)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_LAST_ID).to_numpy(zero_copy_only=False)


def _field(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


_TILE = "tile long, low array<int>, high array<int>, least long, most long, q array<int>, ids array<long>, labels array<long>, copies array<long>, ends array<long>"


def build_tiles(vectors: DataFrame, width: int, tile_rows: int, ranges: int) -> DataFrame:
    """One row a tile: its rows in packed order, where its leaves end, and its box.

    The first cut is Spark's: ranges of (label, first coordinates, id). Each task
    packs its range, in chunks of at most ``tile_rows``.
    """

    def pack(tile: int, parts: list[pa.RecordBatch]) -> list:
        chunk = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        rows, ids = _matrix(_field(chunk, "q"), width), _ids(_field(chunk, "vec_id"))
        labels, copies = (_field(chunk, name).to_numpy() for name in ("label", "copies"))
        order, ends = tile_order(rows, ids, labels, LEAF)
        rows, labels = rows[order], labels[order]
        box = [rows.min(axis=0), rows.max(axis=0), int(labels[0]), int(labels[-1])]
        return [tile, *box, rows.ravel(), ids[order], labels, copies[order], ends]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tile = TaskContext.get().partitionId() << 32
        held, rows = [], 0

        def out() -> pa.RecordBatch:
            fields = pack(tile, held)
            kinds = [pa.int64(), *[pa.list_(pa.int32())] * 2, *[pa.int64()] * 2, pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 4]
            names = [part.split()[0] for part in _TILE.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([f], k) for f, k in zip(fields, kinds, strict=True)], names)

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, tile_rows - rows)
                batch = batch.slice(part.num_rows)
                held, rows = [*held, part], rows + part.num_rows
                if rows == tile_rows:
                    yield out()
                    tile, held, rows = tile + 1, [], 0
        if rows:
            yield out()

    first = [F.get("q", F.lit(i)) for i in range(2)]
    ranged = vectors.repartitionByRange(ranges, "label", *first, "vec_id", F.xxhash64("q"))
    return ranged.mapInArrow(run, _TILE)


def _tile_rows(spark, count: int) -> int:
    """Rows of a tile: enough tiles for all cores, none larger than TILE_ROWS, no more than MAX_TILES tiles."""
    even = -(-count // (4 * spark.sparkContext.defaultParallelism))
    return max(min(TILE_ROWS, max(even, LEAF)), -(-count // MAX_TILES))


def _met(anchors: DataFrame, tiles: DataFrame, width: int, same: bool) -> DataFrame:
    """``tile, anchor_no, vec_id, label, q, windows`` for each tile whose box an anchor's windows reach.

    The boxes of the tiles, at most about MAX_TILES, are broadcast.
    """
    boxes = tiles.select("tile", "low", "high", "least", "most").toArrow().combine_chunks()
    names, least, most = (boxes[c].to_numpy() for c in ("tile", "least", "most"))
    low, high = (np.stack(boxes[c].to_numpy()) if len(names) else np.zeros((0, width), np.int32) for c in ("low", "high"))
    shared = anchors.sparkSession.sparkContext.broadcast((names, low, high, least, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, low, high, least, most = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                label = _field(part, "label").to_numpy()[:, None]
                low_bound, high_bound = box_bounds(_matrix(_field(part, "q"), width), low, high)
                if same:
                    meets = (least <= label) & (label <= most)
                else:
                    windows = [_pairs(w) for w in _field(part, "windows").to_pylist()]
                    meets = np.array([((h[:, None] >= w[:, 0]) & (l[:, None] <= w[:, 1])).any(axis=1) for w, l, h in zip(windows, low_bound, high_bound, strict=True)])
                    meets &= (least != label) | (most != label)
                who, where = np.nonzero(meets)
                for start in range(0, len(who), 4096):
                    own = part.take(pa.array(who[start : start + 4096]))
                    tile = pa.array(names[where[start : start + 4096]])
                    yield pa.RecordBatch.from_arrays([tile, *own.columns], ["tile", *own.schema.names])

    found = anchors.select("anchor_no", "vec_id", "label", "q", "windows")
    return found.mapInArrow(run, "tile long, anchor_no long, vec_id long, label long, q array<int>, windows array<long>")


def _pairs(flat: list[int]) -> np.ndarray:
    return np.array(flat, np.int64).reshape(-1, 2)


def _searched(anchors: DataFrame, tiles: DataFrame, tasks: int, width: int, most: int, same: bool) -> DataFrame:
    """``anchor_no, slot, score, vec_id, place``: the first ``most`` rows of every anchor's windows.

    Each tile and the anchors that reach it go to one task, the tile first: the
    task builds its tree and streams the anchors past it, so it holds one tile
    and one batch. Each tile answers with its own first rows, and those of all
    tiles are merged by anchor and window.
    """
    none = F.lit(None)
    held = tiles.select(
        "tile", F.lit(0).alias("kind"), none.cast("long").alias("anchor_no"), none.cast("long").alias("vec_id"),
        none.cast("long").alias("label"), "q", none.cast("array<long>").alias("windows"), "ids", "labels", "copies", "ends",
    )
    asked = _met(anchors, tiles, width, same).withColumn("kind", F.lit(1))
    for name in ("ids", "labels", "copies", "ends"):
        asked = asked.withColumn(name, none.cast("array<long>"))
    together = held.unionByName(asked).repartition(tasks, "tile").sortWithinPartitions("tile", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, tile = None, None
        for batch in batches:
            tile_of, kinds = _field(batch, "tile").to_numpy(), _field(batch, "kind").to_numpy()
            at = 0
            while at < batch.num_rows:
                if kinds[at] == 0:
                    one = batch.slice(at, 1)
                    arrays = [_field(one, c).flatten().to_numpy() for c in ("q", "ids", "labels", "copies", "ends")]
                    tree, tile = BoxTree(arrays[0].reshape(-1, width), *arrays[1:]), tile_of[at]
                    at += 1
                    continue
                # A shuffled table always brings a tile before the anchors that were sent to it.
                assert tile == tile_of[at]
                same_tile = (tile_of[at:] == tile) & (kinds[at:] == 1)
                size = len(same_tile) if same_tile.all() else int(np.argmin(same_tile))
                for start in range(at, at + size, 256):
                    yield _answers(tree, batch.slice(start, min(256, at + size - start)), width, most, same)
                at += size

    found = together.mapInArrow(run, "anchor_no long, slot int, score long, vec_id long")
    order = Window.partitionBy("anchor_no", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def _answers(tree: BoxTree, asked: pa.RecordBatch, width: int, most: int, same: bool) -> pa.RecordBatch:
    windows = [_pairs(w) for w in _field(asked, "windows").to_pylist()]
    anchors, ids, labels = _matrix(_field(asked, "q"), width), _ids(_field(asked, "vec_id")), _field(asked, "label").to_numpy()
    numbers = _field(asked, "anchor_no").to_numpy()
    found = list(tree.search(anchors, ids, labels, windows, most, same))
    sizes = [len(scores) for _, _, scores, _ in found]
    columns = [
        np.repeat(np.array([numbers[i] for i, *_ in found], np.int64), sizes),
        np.repeat(np.array([w for _, w, *_ in found], np.int32), sizes),
        np.concatenate([np.zeros(0, np.int64), *[scores for _, _, scores, _ in found]]),
        np.concatenate([np.zeros(0, np.int64), *[names for *_, names in found]]),
    ]
    arrays = [pa.array(c) for c in columns[:3]] + [pa.array(columns[3], mask=columns[3] == _LAST_ID)]
    return pa.RecordBatch.from_arrays(arrays, ["anchor_no", "slot", "score", "vec_id"])


def mine_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    most_percent: int = MOST_PERCENT,
    tile_rows: int | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, positive_no, rank, negative_id, positive_score, negative_score``.

    ``vectors`` as ``labelled_vectors`` gives them. For each anchor the first
    ``positives`` other rows of its label, by falling inner product and then by
    id; for each of those the first ``negatives`` rows of other labels whose score
    is between the two percentages of the positive's. Anchors without a positive
    and positives without a negative give no row. Rows are exact; no candidate is
    sampled or capped. Equal rows (same id, label and components) count as often
    as they occur, as anchors, positives and negatives alike. Vectors of
    different lengths are compared as if the shorter one ended in zeros. An empty
    table gives no row. Ids are told from none by the largest long, which no row
    may have as its id.
    """
    vectors = stored(vectors, "negatives-vectors")
    count, width = vectors.agg(F.count("*"), F.max(F.size("q"))).first()
    width = max(width or 0, 1)
    tile_rows = tile_rows or _tile_rows(vectors.sparkSession, count)
    ranges = max(1, -(-count // tile_rows))
    tiles = stored(build_tiles(vectors, width, tile_rows, ranges), "negatives-tiles")
    everything = F.array(F.lit(_LOWEST), F.lit(_HIGHEST))
    anchors = vectors.where(is_anchor).withColumn("anchor_no", F.monotonically_increasing_id())
    # Stored before their numbers are used, so that these never change.
    anchors = stored(anchors, "negatives-anchors")
    first = _searched(anchors.withColumn("windows", everything), tiles, ranges, width, positives, same=True)
    first = stored(first.select("anchor_no", "place", "score", "vec_id"), "negatives-positives")
    # Lowest and highest whole score of each positive's window; empty ones stay, so that slots are places.
    share = lambda percent: F.col("s") * percent
    windows = first.select(
        "anchor_no",
        "place",
        F.col("score").cast("decimal(20,0)").alias("s"),
    ).select(
        "anchor_no",
        F.struct(
            "place",
            F.ceil(share(least_percent) / F.lit(100)).cast("long").alias("low"),
            F.floor(share(most_percent) / F.lit(100)).cast("long").alias("high"),
        ).alias("w"),
    )
    grouped = windows.groupBy("anchor_no").agg(F.sort_array(F.collect_list("w")).alias("w"))  # at most `positives` each
    flat = F.flatten(F.transform("w", lambda w: F.array(w["low"], w["high"])))
    ready = anchors.join(grouped.select("anchor_no", flat.alias("windows")), "anchor_no")
    second = _searched(ready, tiles, ranges, width, negatives, same=False)
    positive = first.select(
        "anchor_no",
        (F.col("place") - 1).alias("slot"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    named = anchors.select("anchor_no", F.col("vec_id").alias("anchor_id"), F.col("copies").alias("_copies"))
    rows = second.join(positive, ["anchor_no", "slot"]).join(named, "anchor_no")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(
        "anchor_id",
        "positive_id",
        (F.col("slot") + 1).alias("positive_no"),
        F.col("place").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
