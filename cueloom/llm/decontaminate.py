"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window of ``span`` words holds ``span - gram + 1`` word grams; the least of
their hashes is the window's fingerprint. Equal windows have equal fingerprints,
so a join of the two sides' fingerprints misses no shared span of ``span`` words.
Neighbouring windows mostly share their fingerprint, so a window is joined only if
its fingerprint is new or enough windows have passed. Hits are extended: the
windows that a joined one stands for are compared word by word.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueloom.llm.common import put_back, set_aside, stored, text_key

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _split(text: Column) -> Column:
    words = F.filter(F.split(text, _BREAKS), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def words(text: Column) -> Column:
    """Words of a text: A-Z in lower case, then runs of digits, a-z and non-ASCII characters. Null has none."""
    return _split(F.translate(text, ascii_uppercase, ascii_lowercase))


def _rough(text: Column) -> Column:
    """All letters in lower case: faster than A-Z only, and words equal under that are equal under this.

    Lower case of a sigma depends on its neighbours, so its two forms are made one.
    """
    return F.replace(F.lower(text), F.lit("ς"), F.lit("σ"))


def _prints(df: DataFrame, length: int, gram: int) -> DataFrame:
    """Fingerprints of the windows of ``length`` words of column ``rough``, the other columns repeated.

    Adds ``at``, a window's first word, and ``hash``. A window whose fingerprint is
    that of the one before is left out unless ``at`` is a multiple of the number of
    grams: each window is among that many from some row on, with equal hash. A row
    without a window gets one row of nulls. Words of a window stand side by side
    as columns, which keeps the hashing in compiled code.
    """
    width = length - gram + 1
    others = [c for c in df.columns if c != "rough"]
    count = F.size("rough") - (length - 1)
    hashed = df.select(*others, F.transform("rough", lambda w: F.xxhash64(w)).alias("_h"), count.alias("_n"))
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice("_h", F.lit(1), F.col("_n") - 1))
    shifted = [F.slice("_h", F.lit(j + 1), F.col("_n")) for j in range(length)]
    zipped = F.arrays_zip(F.sequence(F.lit(0), F.col("_n") - 1), before, *shifted)
    names = ["at", "before", *[f"w{j}" for j in range(length)]]
    rows = hashed.select(*others, F.inline_outer(F.when(F.col("_n") > 0, zipped))).toDF(*others, *names)

    def least(first: int) -> Column:
        hashes = [F.xxhash64(*names[1 + first + i : 1 + first + i + gram]) for i in range(width)]
        return F.least(*hashes) if width > 1 else hashes[0]

    rows = rows.select(*others, "at", least(1).alias("hash"), least(0).alias("_before"))
    new = F.col("at").isNull() | (F.col("at") % width == 0) | (F.col("hash") != F.col("_before"))
    return rows.where(new).drop("_before")


def _item_windows(items: DataFrame, span: int) -> DataFrame:
    """``item_id, gram`` (words joined by a space) and ``words_in`` (its length): every window of every item, null ids included."""
    listed = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    sized = listed.withColumn("n", F.size("w")).where("n > 0")
    sized = sized.withColumn("words_in", F.least("n", F.lit(span)))
    starts = sized.withColumn("at", F.explode(F.sequence(F.lit(1), F.expr("n - words_in + 1"))))
    gram = F.array_join(F.expr("slice(w, at, words_in)"), " ")
    return starts.select("item_id", "words_in", gram.alias("gram")).distinct()


def _matches(docs: DataFrame, items: DataFrame, span: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """All documents (``doc_id, _key, n_words, copies``), and ``_spans`` of those that are hit."""
    base = docs.select("doc_id", text_key().alias("_key"), F.col("text").cast("string").alias("text"))
    windows = stored(_item_windows(items, span), "item-windows")
    lengths = sorted(r["words_in"] for r in windows.select("words_in").distinct().collect())  # at most `span`
    tables = []
    for length in lengths or [span]:
        own = windows.where(F.col("words_in") == length)
        anchored = stored(_anchors(base, own, length, min(gram, length)), "anchors")
        tables.append((anchored, _hits(base, anchored, own, length, min(gram, length))))
    hits = reduce(DataFrame.unionByName, [found for _, found in tables])
    spans = stored(_spans(hits), "spans").withColumnsRenamed({"doc_id": "_id", "_key": "_k"})
    return tables[0][0].select("doc_id", "_key", "n_words", "copies"), spans


def _anchors(base: DataFrame, windows: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, _key, n_words``, how often the document is there, and where fingerprints meet those of items."""
    listed = windows.select(F.split(_rough(F.col("gram")), " ").alias("rough"))
    met = _prints(listed, length, gram).where("at is not null").select("hash").distinct()
    met = stored(met, "item-prints").withColumn("_met", F.lit(True))
    rough = base.select("doc_id", "_key", _split(_rough(F.col("text"))).alias("rough"))
    prints = _prints(rough.withColumn("n_words", F.size("rough").cast("long")), length, gram)
    # Texts without a window keep a row; a hash of their own spreads them in the join.
    own = F.when(F.col("at").isNull(), F.xxhash64("doc_id", "_key")).otherwise(F.col("hash"))
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    return (
        prints.withColumn("hash", own)
        .join(met, "hash", "left")
        .where(F.col("_met") | first)
        .groupBy("doc_id", "_key", "n_words")
        .agg(
            F.sum(first.cast("long")).alias("copies"),
            F.collect_set(F.when(F.col("_met"), F.col("at"))).alias("anchors"),  # places in one document
        )
    )


def decontaminate(docs: DataFrame, items: DataFrame, span: int = 10, gram: int = 5) -> DataFrame:
    """What of ``items`` (item_id, text) occurs in ``docs`` (doc_id, text), for each row of ``docs``.

    A window is ``span`` consecutive words of an item; an item of fewer words, but
    not none, is one window. Returns ``doc_id, n_words, n_hit`` (words inside any
    occurrence of a window), ``spans`` (merged ``(start, end)`` word ranges, in
    order), ``item_ids`` (text, ascending) of the items whose windows occur and
    ``n_items``, their number. Items with a null id match as others do; they are in no
    ``item_ids`` and together count as one in ``n_items``.
    Documents are told apart by doc_id and text: repeated rows get equal results,
    one row each. Null and empty texts have no words. Items without a word match
    nothing; items may repeat ids. Other columns are ignored.
    """
    counted, spans = _matches(docs, items, span, gram)
    no_spans = F.array().cast("array<struct<start:int,end:int>>")
    counted = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return counted.join(spans, _same("doc_id", "_id", "_key", "_k"), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", no_spans).alias("spans"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, span: int = 10, gram: int = 5) -> DataFrame:
    """``docs`` without the rows in which a window of an item occurs. All columns are kept."""
    _, spans = _matches(docs, items, span, gram)
    hit = spans.select("_id", "_k")
    keyed = set_aside(docs).withColumn("_key", text_key())
    return put_back(keyed.join(hit, _same("doc_id", "_id", "_key", "_k"), "left_anti"), docs.columns)


def _same(*names: str) -> Column:
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(names[::2], names[1::2], strict=True)]
    return reduce(lambda a, b: a & b, pairs)


def _hits(base: DataFrame, anchored: DataFrame, windows: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, _key, at, until, item_id``: every occurrence of a window of ``length`` words."""
    anchored = anchored.where(F.size("anchors") > 0).select(
        F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "n_words", "anchors"
    )
    met = base.join(anchored, _same("doc_id", "_id", "_key", "_k"))
    met = met.select("doc_id", "_key", "n_words", "anchors", words(F.col("text")).alias("w"))
    last = (F.col("n_words") - length).cast("int")
    starts = F.flatten(F.transform("anchors", lambda at: F.sequence(at, F.least(at + (length - gram), last))))
    grams = F.transform(
        F.array_distinct(starts),
        lambda at: F.struct(at.alias("at"), F.array_join(F.slice("w", at + 1, F.lit(length)), " ").alias("gram")),
    )
    # Naming w twice keeps the optimizer from computing it anew for every start.
    found = met.select("doc_id", "_key", F.size("w").alias("_n"), F.explode(grams).alias("s"))
    return (
        found.select("doc_id", "_key", "s.at", "s.gram")
        .join(windows.select("gram", "item_id"), "gram")
        .select("doc_id", "_key", "at", (F.col("at") + length).alias("until"), "item_id")
    )


def _spans(hits: DataFrame) -> DataFrame:
    """Merge a document's hits: its spans, the words they cover and its items."""
    by_doc = hits.groupBy("doc_id", "_key").agg(
        F.array_sort(F.collect_set(F.struct(F.col("at").alias("start"), F.col("until").alias("end")))).alias("_all"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.max(F.col("item_id").isNull().cast("int")).alias("_nameless"),
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")

    # Overlapping hits become one span; the ones before the last are final.
    def add(state, hit):
        apart = state["end"].isNull() | (hit["start"] > state["end"])
        done = F.when(
            apart & state["end"].isNotNull(),
            F.concat(state["done"], F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))),
        ).otherwise(state["done"])
        return F.struct(
            done.alias("done"),
            F.when(apart, hit["start"]).otherwise(state["start"]).alias("start"),
            F.when(apart, hit["end"]).otherwise(F.greatest(state["end"], hit["end"])).alias("end"),
        )

    start = F.struct(empty.alias("done"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))
    merged = F.aggregate(
        "_all",
        start,
        add,
        lambda s: F.concat(s["done"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))),
    )
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    n_items = F.size("item_ids") + F.col("_nameless")
    return by_doc.withColumn("spans", merged).withColumns({"n_hit": covered, "n_items": n_items}).drop("_all", "_nameless")
