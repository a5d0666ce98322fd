"""Connected components over links, as joins and aggregates (union-find without a driver)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueloom.llm.common import stored


def _ends(both: DataFrame) -> DataFrame:
    """Every node's smallest and largest neighbour, of links ``node, near`` in both directions.

    They are stored before they are joined, so that a node with very many links is an ordinary, splittable join key.
    """
    return stored(both.groupBy("node").agg(F.min("near").alias("least"), F.max("near").alias("most")), "star-ends")


def _round(both: DataFrame, ends: DataFrame) -> DataFrame:
    """One large-star and one small-star step.

    Every node's smallest neighbour becomes the parent of its larger neighbours,
    then of its smaller ones.
    """
    least = ends.select("node", F.least("node", "least").alias("least"))
    # A row a link at most, so repeats wait for the last step.
    large = both.join(least, "node").where("near > node").select(F.col("near").alias("child"), F.col("least").alias("parent"))
    large = stored(large, "large-star")
    root = stored(large.groupBy("child").agg(F.min("parent").alias("root")), "star-root")
    joined = large.join(root, "child")
    small = joined.select("child", F.col("root").alias("parent")).unionByName(
        joined.where("parent != root").select(F.col("parent").alias("child"), F.col("root").alias("parent"))
    )
    return stored(small.distinct(), "small-star")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a, b``): the smallest node it is connected to.

    Alternating large-star and small-star steps; rounds grow with the logarithm
    of a component's size. Stops when every node with a smaller neighbour has no other one: then
    all links lead to the smallest node. Links of a node to
    itself and null ends are ignored; a node without links is not in the result.
    """
    stars = stored(
        links.where("a != b")
        .select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
        .distinct(),
        "links",
    )
    while True:
        both = stars.select(F.col("child").alias("node"), F.col("parent").alias("near")).unionByName(
            stars.select(F.col("parent").alias("node"), F.col("child").alias("near"))
        )
        ends = _ends(both)
        if not ends.where("least < node and least != most").count():
            return ends.select("node", F.least("node", "least").alias("root"))
        stars = _round(both, ends)


def bucket_links(members: DataFrame, bucket: list[str], linked) -> DataFrame:
    """All links ``a, b`` that decide connectivity among nodes sharing a bucket.

    ``members`` has ``bucket`` columns, ``node`` and ``weight``; a node may repeat.
    ``linked(pairs)`` takes a frame ``a, b`` of candidate pairs and returns those
    that are links. Pairs within a group are not enumerated: every node is
    compared with its bucket's heaviest node, and what is then connected counts
    as one class. Only nodes of different classes in one bucket are paired, so a
    group of copies costs a comparison a member, and no link between classes is
    lost.
    """
    ends = members.groupBy(*bucket).agg(F.min("node").alias("_low"), F.max("node").alias("_high"))
    several = stored(ends.where("_low != _high").select(*bucket), "buckets")
    members = stored(members.join(several, bucket).select(*bucket, "node", "weight"), "members")
    pivots = members.groupBy(*bucket).agg(F.max(F.struct("weight", "node"))["node"].alias("pivot"))
    pivots = stored(pivots, "pivots")
    shared = stored(members.join(pivots, bucket).select(*bucket, "node", "pivot").distinct(), "shared")
    first = stored(linked(shared.where("node != pivot").select(*_ordered("node", "pivot")).distinct()), "pivot-links")
    classes = components(first)
    named = shared.join(classes, "node", "left").select(*bucket, "node", F.coalesce("root", "node").alias("class"))
    named = stored(named, "classes")
    mixed = named.groupBy(*bucket).agg(F.min("class").alias("_low"), F.max("class").alias("_high"))
    mixed = stored(mixed.where("_low != _high").select(*bucket), "mixed")
    open_ = stored(named.join(mixed, bucket), "open")
    left = open_.select(*bucket, F.col("node").alias("a"), F.col("class").alias("_ca"))
    right = open_.select(*bucket, F.col("node").alias("b"), F.col("class").alias("_cb"))
    across = left.join(right, bucket).where("_ca < _cb").select(*_ordered("a", "b")).distinct()
    return first.unionByName(linked(across))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
