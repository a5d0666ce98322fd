"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame operations only.

A sketch has cells in three tables. Each digest goes to one cell of each table,
which keeps a count and the exclusive or of digests and of their check hashes. Two
sketches subtract cell by cell: common digests vanish, and the differing ones are
peeled off from cells that hold just one. If peeling gets stuck, the digests are
dealt by further hash bits to several sketches of the same size, that is to a larger
sketch, and only parts that got stuck are tried again.
"""

from __future__ import annotations

from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueloom.llm.common import stored

TABLES = 3
WIDTH = 10
CELLS = TABLES * WIDTH
#: A line is cut after a sentence that ends 160 or more code points into it, or else after 320.
PARAGRAPH = r"[^\n]{160}[^\n.!?]{0,160}[.!?]*|[^\n]+"
#: Rounds of peeling before a sketch counts as stuck.
ROUNDS = 6
FANOUT = 8
_CHECK_SALT = 101
#: Rows that a range of ids holds, about; and keys of ids that are looked at to cut one.
RANGE_ROWS = 4096
_SEEN_A_RANGE = 4
#: Equal rows that make a part at least: by chance no part stays empty.
_LEAST_PART = 64
#: Sketches that a task makes and peels, about.
_TASK_ROWS = 16_384


def paragraphs(text: Column) -> Column:
    """Digests of the distinct paragraphs of a text."""
    pieces = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(_CHECK_SALT)).bitwiseAND(F.lit(0xFFFFFFFF))


def _places(digest: Column) -> list[Column]:
    """The cell of a digest in each table."""
    return [(F.pmod(F.xxhash64(digest, F.lit(t)), F.lit(WIDTH)) + t * WIDTH).cast("int") for t in range(TABLES)]


_KEY = ["row", "pair", "part"]


def _sketches(work: DataFrame) -> DataFrame:
    """A row for each cell: count, digests and checks of side ``a`` and of side ``b``.

    ``work`` is partitioned by ``row``, so this and the peeling need no exchange.
    """

    def tagged(side: str, tag: int) -> Column:
        return F.transform(side, lambda d: F.struct(d.alias("d"), F.lit(tag).alias("side")))

    each = work.select(*_KEY, F.explode(F.concat(tagged("a", 0), tagged("b", 1))).alias("e"))
    each = each.select(*_KEY, "e.d", "e.side", _check(F.col("e.d")).alias("c"))
    dealt = each.select(*_KEY, "d", "side", "c", F.explode(F.array(*_places(F.col("d")))).alias("cell"))
    sums = []
    for v, side in ((0, "a"), (1, "b")):
        own = F.col("side") == v
        sums += [
            F.sum(F.when(own, 1).otherwise(0)).alias(f"n{side}"),
            F.bit_xor(F.when(own, F.col("d")).otherwise(0)).alias(f"d{side}"),
            F.bit_xor(F.when(own, F.col("c")).otherwise(0)).alias(f"c{side}"),
        ]
    return dealt.groupBy(*_KEY, "cell").agg(*sums)


def _cell(i: Column | str, n: Column, d: Column, c: Column) -> Column:
    i = F.col(i) if isinstance(i, str) else i
    return F.struct(i.cast("int").alias("i"), n.cast("long").alias("n"), d.cast("long").alias("d"), c.cast("long").alias("c"))


_FOUND = -1


def _peeled(cells: DataFrame) -> DataFrame:
    """``_KEY, found, stuck`` from rows ``_KEY, cells``: how many digests differ, and whether cells are left.

    A round takes the digests of all cells that hold just one out of all their
    cells. The number found so far travels as one more cell.
    """
    for _ in range(ROUNDS):
        pure = F.filter(
            "cells", lambda x: (x["i"] >= 0) & (F.abs(x["n"]) == 1) & (_check(x["d"]) == x["c"])
        )
        taken = F.array_distinct(F.transform(pure, lambda x: F.struct(x["n"].alias("n"), x["d"].alias("d"))))
        round_ = cells.select(*_KEY, "cells", taken.alias("taken"))
        out = F.flatten(
            F.transform(
                "taken", lambda t: F.array(*[_cell(p, -t["n"], t["d"], _check(t["d"])) for p in _places(t["d"])])
            )
        )
        zero = F.lit(0)
        tally = F.array(_cell(F.lit(_FOUND), F.size("taken"), zero, zero))
        moved = round_.select(*_KEY, F.explode(F.concat("cells", out, tally)).alias("x")).select(*_KEY, "x.*")
        summed = moved.groupBy(*_KEY, "i").agg(F.sum("n").alias("n"), F.bit_xor("d").alias("d"), F.bit_xor("c").alias("c"))
        left = summed.where((F.col("i") == _FOUND) | (F.col("n") != 0) | (F.col("d") != 0) | (F.col("c") != 0))
        cells = left.groupBy(*_KEY).agg(F.collect_list(_cell("i", F.col("n"), F.col("d"), F.col("c"))).alias("cells"))
    found = F.filter("cells", lambda x: x["i"] == _FOUND)
    return cells.select(*_KEY, F.get(found, F.lit(0))["n"].alias("found"), (F.size("cells") > 1).alias("stuck"))


def _hex(value: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(value)), digits, "0")


def _written(cells: str, side: str) -> Column:
    """A sketch as text: for each cell count (4 digits or more), digests (16) and checks (8), hexadecimal."""
    texts = F.transform(
        F.array_sort(cells), lambda x: F.concat(_hex(x["cell"], 2), _hex(x["n" + side], 4), _hex(x["d" + side], 16), _hex(x["c" + side], 8))
    )
    return F.array_join(F.filter(texts, lambda x: F.substring(x, 3, 28) != "0" * 28), "")


def _spread(work: DataFrame) -> DataFrame:
    """Partitions by ``row`` of a bounded number of rows. They are small until they are made to sketches, so bytes do not tell."""
    return work.repartition(1 + work.count() // _TASK_ROWS, "row")


def differences(work: DataFrame) -> DataFrame:
    """``row, pair, found``: how many digests differ between ``a`` and ``b`` (arrays without repeats).

    ``work`` has ``row, pair, a, b``. Sketches are subtracted and peeled. Where
    peeling gets stuck, the part is tried again as ``FANOUT`` sketches, until all are solved.
    """
    work = work.withColumn("part", F.lit(0).cast("long"))
    solved, level = [], 0
    while True:
        work = _spread(work)
        sketch = _sketches(work).select(
            *_KEY, _cell("cell", F.col("na") - F.col("nb"), F.col("da").bitwiseXOR(F.col("db")), F.col("ca").bitwiseXOR(F.col("cb"))).alias("x")
        )
        kept = sketch.where("x.n != 0 or x.d != 0 or x.c != 0").groupBy(*_KEY).agg(F.collect_list("x").alias("cells"))
        result = stored(_peeled(kept), "peeled")
        solved.append(result.where("not stuck").select("row", "pair", "found"))
        stuck = result.where("stuck").select(*_KEY)
        if stuck.isEmpty():
            break
        level += 1
        again = work.join(stuck, _KEY)
        dealt = lambda side: again.select(*_KEY, F.explode(side).alias("d"), F.lit(side).alias("side"))
        both = dealt("a").unionByName(dealt("b"))
        further = F.col("part") * FANOUT + F.pmod(F.xxhash64("d", F.lit(1000 + level)), F.lit(FANOUT))
        parts = both.withColumn("part", further).groupBy(*_KEY)
        pick = lambda side: F.collect_list(F.when(F.col("side") == side, F.col("d"))).alias(side)
        work = stored(parts.agg(pick("a"), pick("b")), "parts")
    return reduce(DataFrame.unionByName, solved).groupBy("row", "pair").agg(F.sum("found").alias("found"))


def _order_key() -> Column:
    """A text that orders rows as they follow each other: descending doc_id, null last, then the hash of their text."""
    falling = F.bitwise_not(F.col("doc_id")).bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    id_ = F.when(F.col("doc_id").isNull(), F.lit("1" + "0" * 16)).otherwise(F.concat(F.lit("0"), F.lpad(F.hex(falling), 16, "0")))
    return F.concat(id_, F.lpad(F.hex(F.xxhash64("text")), 16, "0"))


def _cuts(keys: DataFrame, rows: int) -> list[str]:
    """The keys that ranges begin with, ascending: the first key, every repeated one that fills a range, and a sample by hash.

    One key in ``rows`` reaches the driver's list, 33 characters each.
    """
    seen = max(1, rows // _SEEN_A_RANGE)
    sampled = keys.where(F.pmod(F.xxhash64("key"), F.lit(seen)) == 0).select("key").orderBy("key")
    cuts = {r["key"] for r in islice(sampled.toLocalIterator(), 0, None, _SEEN_A_RANGE)}
    cuts |= {r["key"] for r in keys.where(F.col("n") > rows).select("key").toLocalIterator()}
    first = keys.agg(F.min("key").alias("key")).first()["key"]
    return sorted(cuts | ({first} - {None}))


def _last_not_above(cuts: Column, count: int, key: str) -> Column:
    """Place of the last of the ascending ``cuts`` that is not above ``key``: a binary search."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(count.bit_length()))])
    step = lambda at, by: F.when((at + by < count) & (F.get(cuts, at + by) <= F.col(key)), at + by).otherwise(at)
    return F.aggregate(steps, F.lit(0), step)


def with_next(docs: DataFrame, rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, text, own, next_text, next_own``: each row with the one after it, in descending doc_id.

    After the last row comes the first; a single row is its own next. Equal ids go
    by the hash of their text, null ids come last, a null text is empty. ``own``
    are the paragraph digests. Rows are ranked inside ranges of about ``rows``
    rows, cut between ids or, where many rows share one, between their texts. A
    range also gets a copy of the row that the next one begins with. More than
    ``rows`` equal rows are dealt to several parts: all but those of the first part
    are followed by their own like.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("key", _order_key())
    keys = stored(base.groupBy("key").agg(F.count("*").alias("n")), "row-keys")
    cuts = _cuts(keys, rows) or [""]
    count, listed = len(cuts), F.split(F.lit(",".join(cuts)), ",")
    # At most one key for `rows` rows.
    many = keys.where(F.col("n") > rows).select(F.col("key").alias("_many"), F.ceil(F.col("n") / max(rows, _LEAST_PART)).alias("_parts"))
    dealt = base.join(F.broadcast(many), F.col("key") == F.col("_many"), "left")
    part = F.when(F.col("_parts").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts")))
    placed = dealt.withColumns({"range": _last_not_above(listed, count, "key"), "part": part})
    begins = (F.get(listed, F.col("range")) == F.col("key")) & (F.col("part") == 0)
    place = lambda range_, part, copy: F.struct(range_.alias("range"), part.alias("part"), F.lit(copy).alias("copy"))
    own_place = place(F.col("range"), F.col("part"), False)
    before = place(F.pmod(F.col("range") + (count - 1), F.lit(count)), F.lit(0).cast("long"), True)
    places = F.when(begins, F.array(own_place, before)).otherwise(F.array(own_place))
    spread = placed.select("doc_id", "text", "key", paragraphs(F.col("text")).alias("own"), F.explode(places).alias("place"))
    order = Window.partitionBy("place.range", "place.part").orderBy("place.copy", "key", "text")
    row = F.struct("text", "own")
    led = spread.withColumn("_next", F.coalesce(F.lead(row).over(order), row)).where("not place.copy")
    return led.select("doc_id", "text", "own", F.col("_next.text").alias("next_text"), F.col("_next.own").alias("next_own"))


def edited(text: str = "text", next_text: str = "next_text") -> Column:
    """The text whose last third of code points, rounded down, is replaced by the first as many of the next."""
    third = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), F.char_length(text) - third), F.substring(F.col(next_text), F.lit(1), third))


def likeness(size_a: Column, size_b: Column, found: Column) -> Column:
    """Shared paragraphs over all paragraphs of both; 1 if there are none."""
    return F.when(size_a + size_b == 0, F.lit(1.0)).otherwise((size_a + size_b - found) / (size_a + size_b + found))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Sketch every text of ``docs`` (doc_id, text) and its edit, and compare.

    Returns, for each row, ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint`` (sketches as text; empty for an empty text), ``near_edited``
    and ``near_next``: the likeness of the own paragraphs to the edit's and to the
    next row's, from what peeling finds to differ. Equal texts have equal sketches.
    Null and empty texts are alike: no paragraphs. Rows are numbered, so repeated
    rows and ids are rows like any other. Other columns are ignored.
    """
    changed = with_next(docs).withColumn("edit", edited())
    base = changed.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edit", 256).alias("edited_sha256"),
        "own",
        paragraphs(F.col("edit")).alias("edit"),
        F.col("next_own").alias("next"),
    )
    base = stored(base, "digests")
    pair = lambda name, other: F.struct(F.lit(name).alias("pair"), F.col("own").alias("a"), F.col(other).alias("b"))
    work = base.select("row", F.explode(F.array(pair(0, "edit"), pair(1, "next"))).alias("p")).select("row", "p.*")
    found = differences(work)
    found = found.groupBy("row").pivot("pair", [0, 1]).agg(F.first("found"))
    first = base.select("row", F.lit(0).alias("pair"), F.lit(0).alias("part"), F.col("own").alias("a"), F.col("edit").alias("b"))
    cells = _sketches(_spread(first))
    listed = cells.groupBy("row").agg(F.collect_list(F.struct("cell", "na", "da", "ca", "nb", "db", "cb")).alias("cells"))
    prints = listed.select("row", _written("cells", "a").alias("fingerprint"), _written("cells", "b").alias("edited_fingerprint"))
    meta = base.select("row", "doc_id", "n_chars", "edited_sha256", *[F.size(c).alias(f"_{c}") for c in ("own", "edit", "next")])
    differ = lambda name: F.coalesce(F.col(name), F.lit(0))
    return (
        meta.join(prints, "row", "left")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
            F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
            likeness(F.col("_own"), F.col("_edit"), differ("0")).alias("near_edited"),
            likeness(F.col("_own"), F.col("_next"), differ("1")).alias("near_next"),
        )
    )
