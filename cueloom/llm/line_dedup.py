"""Line dedup: MinHash of character shingles, banding, exact Jaccard check, one line kept per component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from cueloom.llm.common import as_bytes, as_list, pieces_of, put_back, set_aside, stored, text_key
from cueloom.llm.components import components

SHINGLE = 8
SIMILARITY = 0.8
#: A pair at similarity 0.8 shares one of 14 bands of 4 with probability 0.9994.
BANDS, ROWS = 14, 4
#: Bits of a minimum that a band keeps; below the band's number.
_FIELD = 14
#: 64-bit words of a line's bitmap.
_WORDS = 64
_HASHED_AT_ONCE = 1 << 15
#: About so many lines of a band, twice at most, are compared in one go.
_BLOCK = 256
#: Characters of lines whose packed shingles a task holds, some 8 bytes each.
_CACHED = 2_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.random.default_rng(7).integers(1, 2**63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLIERS = np.random.default_rng(11).integers(1, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _ODD
    return values ^ (values >> np.uint64(29))


def _shingle_hashes(points: np.ndarray) -> np.ndarray:
    """Hash of the 8 code points from each place on, by doubling."""
    hashes = (points.astype(np.uint64) + np.uint64(1)) * _ODD
    for step, power in zip((1, 2, 4), _POWERS, strict=True):
        hashes = hashes[:-step] * power + hashes[step:]
    return _mixed(hashes)


def band_hashes(lines: list[str]) -> np.ndarray:
    """A row of ``BANDS`` numbers for each (non-empty) line; lines agree on a band if ROWS minima agree.

    A number is the band's own, then 14 bits of each minimum.

    A line shorter than a shingle is one shingle.
    """
    out = np.zeros((len(lines), BANDS), np.uint64)
    at = 0
    while at < len(lines):
        upto, size = at, 0
        while upto < len(lines) and (upto == at or size + len(lines[upto]) <= _HASHED_AT_ONCE):
            size += len(lines[upto])
            upto += 1
        out[at:upto] = _bands_of(lines[at:upto])
        at = upto
    return out


def _hashes_of(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of all lines, one after the other, and how many each line has."""
    # Padding gives a short line its one shingle.
    points = np.frombuffer("".join(x.ljust(SHINGLE, "\0") for x in lines).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.array([max(len(x), SHINGLE) for x in lines])
    ends = np.cumsum(lengths)
    hashes = _shingle_hashes(points)
    inside = np.ones(len(hashes), bool)
    for back in range(1, SHINGLE):
        inside[ends[:-1] - back] = False
    return (hashes[inside] >> np.uint64(32)).astype(np.uint32), lengths - SHINGLE + 1


def _bands_of(lines: list[str]) -> np.ndarray:
    hashes, counts = _hashes_of(lines)
    starts = np.cumsum(counts) - counts
    product, minima = np.empty_like(hashes), np.empty((BANDS * ROWS, len(lines)), np.uint32)
    for multiplier, least in zip(_MULTIPLIERS, minima, strict=True):
        np.minimum.reduceat(np.multiply(hashes, multiplier, out=product), starts, out=least)
    fields = (minima * np.uint32(0x9E3779B1) >> np.uint32(32 - _FIELD)).astype(np.uint64).reshape(BANDS, ROWS, -1)
    bands = np.arange(BANDS, dtype=np.uint64)[:, None]
    for row in range(ROWS):
        bands = bands << np.uint64(_FIELD) | fields[:, row]
    return bands.T


def bitmaps(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each line, 64 x ``_WORDS`` bits, those of its shingles set, and its number of shingles, repeats included.

    A bit that one line has and another has not stands for a shingle that only one of them has.
    """
    words, sizes = np.zeros((len(lines), _WORDS), np.uint64), np.empty(len(lines), np.int64)
    for at in range(0, len(lines), 64):
        hashes, counts = _hashes_of(lines[at : at + 64])
        sizes[at : at + 64] = counts
        bits = np.zeros((len(counts), 64 * _WORDS), np.uint8)
        bits[np.repeat(np.arange(len(counts)), counts), hashes % np.uint32(64 * _WORDS)] = 1
        words[at : at + 64] = np.packbits(bits, axis=1).view(np.uint64)
    return words, sizes


def may_be_similar(words: np.ndarray, others: np.ndarray, shingles: np.ndarray, similarity: float) -> np.ndarray:
    """Whether lines of these bitmaps, with so many shingles in both, can be similar; never false for lines that are.

    Similarity s of sets with m and n members leaves (m + n) (1 - s) / (1 + s) that only one of them has.
    """
    return np.bitwise_count(words ^ others).sum(-1, dtype=np.int64) <= shingles * ((1 - similarity) / (1 + similarity) + 1e-9)


def shingles(line: str) -> set[str]:
    """A line's 8-character shingles; a shorter line is one shingle."""
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def jaccard(left: set[str], right: set[str]) -> float:
    """Exact similarity of two lines' shingle sets."""
    both = len(left & right)
    return both / (len(left) + len(right) - both)


def _packed(line: str) -> np.ndarray | None:
    """The line's shingles, each once, as sorted numbers of a byte a character; none if it is too short or has other characters."""
    try:
        raw = line.encode("latin-1")
    except UnicodeEncodeError:
        return None
    if len(raw) < SHINGLE:
        return None
    every = np.sort(np.ndarray(len(raw) - SHINGLE + 1, "<u8", raw, strides=(1,)))
    return every[np.append(True, every[1:] != every[:-1])]


class ShingleCache:
    """Packed shingles of the lines asked for last; forgets all of them when they hold too many characters."""

    def __init__(self, characters: int = _CACHED) -> None:
        self._characters, self._held = characters, 0
        self._sets: dict[str, np.ndarray | None] = {}

    def __getitem__(self, line: str) -> np.ndarray | None:
        if line not in self._sets:
            if self._held > self._characters:
                self._sets, self._held = {}, 0
            self._sets[line] = _packed(line)
            self._held += len(line)
        return self._sets[line]


def are_similar(a: str, b: str, similarity: float, sets: ShingleCache) -> bool:
    left, right = sets[a], sets[b]
    if left is None or right is None:
        # Two lines seldom have more than 256 different characters: numbered, they pack as well.
        numbers = {ord(c): i for i, c in enumerate({*a, *b})}
        if len(numbers) <= 256:
            left, right = _packed(a.translate(numbers)), _packed(b.translate(numbers))
        if left is None or right is None:
            return jaccard(shingles(a), shingles(b)) >= similarity
    # Sets whose sizes differ by more than the similarity allows need no comparison.
    if min(len(left), len(right)) < similarity * max(len(left), len(right)):
        return False
    every = np.sort(np.concatenate([left, right]), kind="stable")  # a merge, as both are sorted
    both = int(np.count_nonzero(every[1:] == every[:-1]))
    return both / (len(left) + len(right) - both) >= similarity


_LINES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("_key", T.LongType()),
        T.StructField("line_no", T.IntegerType()),
        T.StructField("line", T.LongType()),
        T.StructField("check", T.LongType()),
        T.StructField("here", T.IntegerType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)
_LINE_FIELDS = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each line that is not blank: place, two 64-bit hashes, and at its first place in a batch
    how often it is there and its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            seen: dict[bytes, int] = {}
            places, whose = [], []
            ids, keys = as_list(batch, "doc_id"), as_list(batch, "_key")
            for i, text in enumerate(as_bytes(batch, "text")):
                for number, line in enumerate((text or b"").split(b"\n")):
                    if line.strip():
                        whose.append(seen.setdefault(line, len(seen)))
                        places.append((ids[i], keys[i], number))
            lines = list(seen)
            names = _signed([xxh64_intdigest(x, 1) for x in lines])
            checks = _signed([xxh64_intdigest(x, 2) for x in lines])
            bands = band_hashes([x.decode("utf-8", "surrogatepass") for x in lines]).view(np.int64)
            _, at, times = np.unique(whose, return_index=True, return_counts=True)
            here = np.zeros(len(whose), np.int32)
            here[at] = times
            whose, seldom = np.array(whose, np.int64), here == 0
            offsets = np.concatenate([[0], np.cumsum(np.where(seldom, 0, BANDS))]).astype(np.int32)
            own = bands[whose[~seldom]].ravel()
            columns = [*zip(*places, strict=True), names[whose], checks[whose]] if places else [[] for _ in _LINE_FIELDS[:5]]
            arrays = [pa.array(c, t) for c, t in zip(columns, _LINE_FIELDS, strict=True)]
            arrays.append(pa.array(here, pa.int32(), mask=seldom))
            arrays.append(pa.ListArray.from_arrays(offsets, own, mask=pa.array(seldom)))
            yield pa.RecordBatch.from_arrays(arrays, _LINES.names)

    return docs.mapInArrow(run, _LINES)


def _linked(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs ``a, b`` of line hashes, those whose texts (``line, content``) are similar by the exact measure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleCache()
        for batch in pieces_of(batches, 1024):
            left, right = as_list(batch, "left"), as_list(batch, "right")
            known: dict[str, int] = {}
            at, to = (np.array([known.setdefault(x, len(known)) for x in side], np.int64) for side in (left, right))
            words, sizes = bitmaps(list(known))
            possible = may_be_similar(words[at], words[to], sizes[at] + sizes[to], similarity).tolist()
            both = zip(possible, left, right, strict=True)
            kept = [may and are_similar(x, y, similarity, sets) for may, x, y in both]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    met = pairs.join(texts.select(F.col("line").alias("b"), F.col("content").alias("right")), "b")
    met = met.join(texts.select(F.col("line").alias("a"), F.col("content").alias("left")), "a")
    return met.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def joining_links(
    lines: list[str],
    maps: tuple[np.ndarray, np.ndarray],
    classes: np.ndarray,
    blocks: np.ndarray,
    similarity: float,
    sets: ShingleCache,
) -> list[tuple[int, int]]:
    """Links, as places in ``lines``, that join classes: fewer than lines, however many are similar.

    ``maps`` is what ``bitmaps`` has for the lines. Two lines of one class, also of one that a link
    found before has joined, are not compared; nor are lines of one block, if there are two.
    """
    words, sizes = maps
    classes, one = classes.copy(), blocks.min() == blocks.max()
    links = []
    for i in range(len(lines) - 1):
        others = classes[i + 1 :] != classes[i]
        if not one:
            others &= blocks[i + 1 :] != blocks[i]
        at = np.flatnonzero(others) + i + 1
        if len(at):
            at = at[may_be_similar(words[at], words[i], sizes[at] + sizes[i], similarity)]
        for j in at.tolist():
            if classes[j] != classes[i] and are_similar(lines[i], lines[j], similarity, sets):
                links.append((i, j))
                classes[classes == classes[j]] = classes[i]
    return links


def _whole_runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Sorted batches dealt anew, so that rows that agree on ``names`` are in one, with the edges of such runs."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None and held.num_rows:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        edges = _edges(batch, names)
        held = batch.slice(edges[-2]) if len(edges) > 1 else batch
        if len(edges) > 2:
            yield batch.slice(0, edges[-2]), edges[:-1]
    if held is not None and held.num_rows:
        yield held, [0, held.num_rows]


def _edges(batch: pa.RecordBatch, names: list[str]) -> list[int]:
    keys = np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names])
    inner = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
    return [0, *inner.tolist(), batch.num_rows] if batch.num_rows else [0]


def _class_links(open_: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` that join the classes ``left, right`` of a band, of ``band, blocks, node, class, content``.

    A band's lines are dealt to ``blocks`` blocks, and each two blocks meet in a task of their own.
    A block is in as many tasks as there are blocks; what they return is linear in their rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleCache()
        for rows, edges in _whole_runs(batches, ["band", "low", "high"]):
            nodes, classes, blocks = (rows.column(rows.schema.get_field_index(n)).to_numpy() for n in ("node", "class", "block"))
            lines = as_list(rows, "content")
            words, sizes = bitmaps(lines)
            found = []
            for low, high in zip(edges, edges[1:]):
                if (classes[low:high] != classes[low]).any():
                    own = slice(low, high)
                    maps = words[own], sizes[own]
                    links = joining_links(lines[own], maps, classes[own], blocks[own], similarity, sets)
                    found += [(low + i, low + j) for i, j in links]
            a, b = np.array(found, np.int64).reshape(-1, 2).T
            ends = [pa.array(x) for x in (nodes[a], nodes[b], classes[a], classes[b])]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b", "left", "right"])

    block = F.pmod(F.xxhash64("node", "band"), F.col("blocks").cast("long"))
    dealt = open_.withColumn("block", block)
    others = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("low"), F.greatest("block", k).alias("high")),
    )
    units = dealt.select("band", "block", "node", "class", "content", F.explode(others).alias("_u"))
    units = units.select("band", "_u.low", "_u.high", "block", "node", "class", "content")
    units = units.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    return units.mapInArrow(run, "a long, b long, left long, right long")


def _sharing(members: DataFrame) -> DataFrame:
    """``band, node, weight`` of ``members`` (a node perhaps several times) in bands of several nodes.

    Nearly all bands have one. An inner join of the same columns lets Spark shuffle members once and read them twice.
    """
    dealt = members.where("band is not null").repartition("band")
    ends = dealt.groupBy("band").agg(F.min("node").alias("_low"), F.max("node").alias("_high"), F.sum("weight").alias("_all"))
    several = ends.where("_low != _high and _all > 0").select("band")
    return dealt.join(several.hint("shuffle_hash"), "band").groupBy("band", "node").agg(F.sum("weight").alias("weight"))


def line_classes(members: DataFrame, texts, similarity: float) -> DataFrame:
    """``node, root``: the components of all lines that links among lines sharing a band connect.

    ``members`` has ``node, weight, band``, a node perhaps several times;
    ``texts(nodes)`` gives ``line, content``. Every line is compared with its band's
    heaviest one, ties falling differently in each band. Only lines that then are in
    different classes are compared further, first by bitmaps: differing bits are at most the
    shingles that only one of two lines has, so no link is lost. A link that joins two
    classes speaks for all links between them. The heaviest line itself, and so a band of two lines,
    has nothing left to compare.
    """
    members = stored(_sharing(members), "members")
    found = stored(texts(members.select(F.col("node").alias("line")).distinct()), "line-texts")
    order = F.struct("weight", F.xxhash64("node", "band"), "node")
    pivots = stored(members.groupBy("band").agg(F.max(order)["node"].alias("pivot"), F.count("*").alias("nodes")), "pivots")
    shared = members.join(pivots, "band").where("node != pivot")
    star = shared.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    classes = components(stored(_linked(star, found, similarity), "pivot-links"))
    named = shared.where("nodes > 2").join(classes, "node", "left").select("band", "node", F.coalesce("root", "node").alias("class"))
    named = stored(named, "classes")
    mixed = named.groupBy("band").agg(
        F.min("class").alias("_low"), F.max("class").alias("_high"), F.ceil(F.count("*") / _BLOCK).alias("blocks")
    )
    mixed = stored(mixed.where("_low != _high").select("band", "blocks"), "mixed")
    open_ = named.join(mixed, "band").join(found.withColumnRenamed("line", "node"), "node")
    joined = stored(_class_links(open_, similarity), "class-links")
    merged = components(joined.select(F.col("left").alias("a"), F.col("right").alias("b")))
    # A line without a link so far is a class of its own.
    every = classes.unionByName(merged.select("node", F.col("node").alias("root"))).distinct()
    tops = merged.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return every.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def _same_doc(id_: str = "_id", key: str = "_k"):
    return F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("_key").eqNullSafe(F.col(key))


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The keyed documents, and ``_id, _k, drops``: for each document the numbers of the lines that go.

    The lines of a component are equal or linked by a similarity of at least
    ``similarity`` of their 8-character shingle sets. Of each component the line
    with the smallest (doc_id, text hash, line number) stays.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("_key"), F.col("text").cast("string").alias("text"))
    placed = stored(_lines(base), "lines")
    place = F.struct("doc_id", "_key", "line_no")
    known = placed.groupBy("line").agg(
        F.count("*").alias("weight"),
        F.min(place).alias("first"),
        (F.min("check") == F.max("check")).alias("sure"),
    )
    # Two different lines of one 64-bit hash, if they ever meet, are both left alone.
    known = stored(known.where("sure").drop("sure"), "distinct-lines")

    def texts(ends: DataFrame) -> DataFrame:
        wanted = known.join(ends, "line").groupBy(F.col("first.doc_id").alias("_id"), F.col("first._key").alias("_k")).agg(
            F.collect_list(F.struct("line", F.col("first.line_no").alias("no"))).alias("wanted")  # within one document
        )
        found = base.join(wanted, _same_doc()).select(F.split("text", "\n").alias("_all"), "wanted")
        one = F.transform("wanted", lambda w: F.struct(w["line"].alias("line"), F.get(F.col("_all"), w["no"]).alias("content")))
        return found.select(F.size("_all").alias("_n"), F.explode(one).alias("t")).select("t.line", "t.content").distinct()

    # Batches speak for their lines; the line most frequent in one becomes a pivot.
    spoken = placed.where("here is not null").select(F.col("line").alias("node"), F.col("here").alias("weight"), "bands")
    members = spoken.select("node", "weight", F.explode("bands").alias("band"))
    roots = line_classes(members, texts, similarity)
    # A line that is there once and has no link stays.
    kept = known.join(roots, F.col("line") == F.col("node"), "left").where("root is not null or weight > 1")
    kept = stored(kept.select("line", "first", "weight", F.coalesce("root", "line").alias("root")), "line-roots")
    best = kept.groupBy("root").agg(F.min("first").alias("keep"), F.sum("weight").alias("rows")).where("rows > 1")
    # Stored, so that a large component is a join key that Spark can split.
    best = stored(best.select("root", "keep"), "component-lines")
    losing = stored(kept.join(best, "root").select("line", "keep"), "keepers")
    drops = (
        placed.join(losing, "line")
        .where(~place.eqNullSafe(F.struct("keep.doc_id", "keep._key", "keep.line_no")))
        .groupBy(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"))
        .agg(F.collect_set("line_no").alias("drops"))  # within one document
    )
    return base, stored(drops, "line-drops")


def _spares(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, _key, text, _rest) with ``_spare``: false for one of the rows of equal doc_id and text, true for the others."""
    places = rows.groupBy(F.col("doc_id").alias("_id"), F.col("_key").alias("_k")).agg(F.count("*").alias("_times"))
    repeated = stored(places.where("_times > 1").drop("_times"), "repeated")
    once = rows.join(repeated, _same_doc(), "left_anti").withColumn("_spare", F.lit(False))
    # Stored, so that a row's number is the same wherever it is read.
    numbered = rows.join(repeated, _same_doc()).drop("_id", "_k").withColumn("_number", F.monotonically_increasing_id())
    numbered = stored(numbered, "repeated-rows")
    firsts = numbered.groupBy("doc_id", "_key").agg(F.min(F.struct("_rest", "_number"))["_number"].alias("_number"))
    marked = numbered.join(firsts.select("_number", F.lit(False).alias("_spare")), "_number", "left")
    return once.unionByName(marked.drop("_number").withColumn("_spare", F.coalesce("_spare", F.lit(True))))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with repeated and nearly repeated lines removed from ``text``, all columns and rows kept.

    Adds ``n_lines`` and ``n_removed``. Lines are what line feeds separate; blank
    lines are never compared and stay. A null text stays null and has no lines;
    an empty one has one, blank, line. Of rows with equal doc_id and text one, of the
    smallest other columns, keeps lines; the others lose all but their blank ones.
    A text that loses all its lines becomes empty.
    """
    _, drops = repeated_lines(docs, similarity)
    docs = docs.drop("n_lines", "n_removed")
    joined = _spares(set_aside(docs).withColumn("_key", text_key())).join(drops, _same_doc(), "left")
    parts = joined.withColumn("_parts", F.split("text", "\n"))
    numbers = F.sequence(F.lit(0), F.size("_parts") - 1)
    solid = F.filter(numbers, lambda i: F.length(F.translate(F.get(F.col("_parts"), i), " \t\r\x0b\f", "")) > 0)
    every = F.when(F.size(solid) > 0, solid)
    parts = parts.withColumn("drops", F.when(F.col("_spare") & F.col("text").isNotNull(), every).otherwise(F.col("drops")))
    # The kept numbers are a set difference, linear in the number of lines.
    left = parts.withColumn("_left", F.array_except(numbers, F.col("drops")))
    text = F.array_join(F.transform("_left", lambda i: F.get(F.col("_parts"), i)), "\n")
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("_parts")).cast("long")
    removed = F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long")
    counted = left.withColumns({"n_lines": lines, "n_removed": removed})
    shorter = counted.withColumn("text", F.when(F.col("drops").isNull(), F.col("text")).otherwise(text))
    return put_back(shorter, docs.columns, F.col("n_lines"), F.col("n_removed"))
