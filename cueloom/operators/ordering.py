"""Row positions and seeded order without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueloom.runtime import checkpointed

# Row ids hold the partition in the high bits and the row's place in the rest.
_PLACE_BITS = 33

#: Hex digits of a hash that make a bucket.
HASH_DIGITS = 4
_HASH_BUCKETS = 16**HASH_DIGITS


def _running(total: str, order: list[str], by: list[str] = ()) -> Column:
    window = Window.partitionBy(*by) if by else Window
    before = window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(before), F.lit(0))


def with_position(df: DataFrame, order: list[str], by: str) -> DataFrame:
    """Add ``position``: the 0-based rank in ``order`` within each ``by`` group.

    A window over ``by`` would put a group in one task. Here rows are range
    partitioned on ``(by, order)`` and checkpointed, so a group spreads over many
    partitions; a row's rank is its place in the partition plus what the group
    has in earlier partitions. Only the table of (partition, group) counts is
    windowed: as rows are sorted by group, it has at most partitions + groups
    rows.
    """
    ranged = checkpointed(df.repartitionByRange(by, *order).sortWithinPartitions(by, *order))
    ranged = ranged.withColumn("_id", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_id", _PLACE_BITS)
    )
    counts = ranged.groupBy("_part", by).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    shifts = counts.select(
        F.col("_part").alias("_in"),
        F.col(by).alias("_of"),
        (_running("_n", ["_part"], [by]) - F.col("_first")).alias("_shift"),
    )
    same = (F.col("_part") == F.col("_in")) & F.col(by).eqNullSafe(F.col("_of"))
    return ranged.join(shifts, same).select(*df.columns, (F.col("_id") + F.col("_shift")).alias("position"))


def hash_order(key: list[str], seed: int) -> Column:
    """A seeded, engine-independent sort key: md5 over seed and row key."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.col(c).cast("string") for c in key]))


def seeded_shuffle(df: DataFrame, key: list[str], seed: int, by: list[str] = ()) -> DataFrame:
    """Add ``position``: each row's place in a seeded permutation of all rows, or of all rows of its ``by`` group.

    ``key`` must identify a row. The order is by a hash of seed and key, so it is
    the same for every partitioning and rerun. Rows are checkpointed, so that
    costly columns are computed once. Equal hash prefixes form 65,536 even buckets
    whatever the data looks like; the running total over that number of buckets
    gives each its start, and ranking happens inside buckets.
    """
    by = list(by)
    hashed = df.withColumn("_hash", hash_order(key, seed)).withColumn("_bucket", F.left("_hash", F.lit(HASH_DIGITS)))
    hashed = checkpointed(hashed)
    sizes = hashed.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    starts = sizes.select(
        *[F.col(c).alias(f"_of{i}") for i, c in enumerate(by)],
        F.col("_bucket").alias("_start_of"),
        _running("_n", ["_bucket"], by).alias("_start"),
    )
    rank = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_hash", *key)) - 1
    same = F.col("_bucket") == F.col("_start_of")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_of{i}"))
    # At most 65,536 rows without groups; with them the join is Spark's own choice.
    starts = starts if by else F.broadcast(starts)
    joined = hashed.withColumn("_rank", rank).join(starts, same)
    return joined.select(*df.columns, (F.col("_start") + F.col("_rank")).cast("long").alias("position"))
