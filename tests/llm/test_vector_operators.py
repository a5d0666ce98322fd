"""Hard negatives and centroid clustering against plain Python over all pairs."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cueloom.llm.box_tree import BoxTree, box_bounds, tile_order
from cueloom.llm.centroids import MeanOrder, centroid_digest, cluster_vectors, first_centroids, integer_vectors
from cueloom.llm.negatives import labelled_vectors, mine_negatives
from cueloom.llm.vectors import inner_products

SCHEMA = "vec_id long, embedding array<float>, label int"


def _rows(count, dims, seed, labels=4, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, spread, dims).astype(np.float32)], int(rng.integers(labels))) for i in range(count)]


def _usable(rows):
    return [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]


def _product(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def _mined(rows, every=10):
    """Rows of their own, sorted by score and id with none last; the anchor itself is left out by position."""
    rows, out = _usable(rows), []
    last = lambda i: (i is None, i or 0)
    for a, (anchor, v, label) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        scored = [(_product(v, w), i, other) for b, (i, w, other) in enumerate(rows) if b != a]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 80 * score <= 100 * s[0] <= 100 * score]
            out += [(anchor, positive, n, i, score, s) for n, (s, i, _) in enumerate(inside[:5], 1)]
    return sorted(out, key=repr)


def _mine(spark, rows, every=10, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    found = mine_negatives(labelled_vectors(table), F.col("vec_id") % every == 0, **options)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.select(*names).collect()), key=repr)


@pytest.mark.parametrize("dims, tile_rows", [(3, 64), (8, 1000), (64, 300)])
def test_negatives_equal_all_pairs(spark, dims, tile_rows):
    rows = _rows(600, dims, seed=dims)
    found = _mine(spark, rows, tile_rows=tile_rows)
    assert found and found == _mined(rows)


def test_negatives_of_ties_copies_and_unusable_rows(spark):
    rows = _rows(60, 3, seed=5)
    common = [0.5, 0.25, 0.5]
    rows += [(i, common, i % 3) for i in range(100, 160)]  # one vector under many ids and labels
    rows += [(10, rows[10][1], rows[10][2])] * 3 + [(50, common, 1), (50, common, 2)]  # repeated rows, one id of two labels
    rows += [(None, common, 0), (None, [0.5, 0.5, 0.5], 1), (None, None, 1)]
    rows += [(200, None, 1), (210, [1.0, float("nan"), 0.0], 1), (220, [1.0, None, 0.0], 1), (230, [float("inf"), 0.0, 0.0], 1), (240, common, None)]
    rows += [(300, [], 1), (310, [0.5], 1), (320, [0.5, 0.5, 0.5, 0.5, 0.5], 2)]  # other lengths: as if zeros followed
    assert _mine(spark, rows, tile_rows=32) == _mined(rows)


def test_negatives_of_zero_and_negative_scores(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, -1.0], 2), (4, [-1.0, 1.0], 2)]
    assert _mine(spark, rows) == _mined(rows) == [(0, 2, 1, 3, 0, 0)]


def test_negatives_of_nothing(spark):
    assert _mine(spark, []) == []
    assert _mine(spark, [(0, [1.0], 1)]) == []
    table = spark.createDataFrame(_rows(30, 4, seed=1), SCHEMA).withColumn("score", F.lit(1)).withColumn("copies", F.lit(9))
    table = table.withColumn("tile", F.lit("x")).withColumn("q", F.lit("x")).withColumn("slot", F.lit(1))
    found = mine_negatives(labelled_vectors(table), F.col("vec_id") % 10 == 0)
    assert found.count() == len(_mined(_rows(30, 4, seed=1)))


def test_boxes_bound_every_product_and_are_pruned():
    rng = np.random.default_rng(3)
    # Groups far apart: whole boxes lie outside a window.
    rows = np.concatenate([rng.integers(-5, 5, (500, 6)) + 100 * rng.integers(-9, 9, 6) for _ in range(20)]).astype(np.int32)
    ids, labels = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    order, ends = tile_order(rows, ids, labels)
    assert sorted(order) == list(range(len(rows))) and np.diff(np.append(0, ends)).max() <= 128
    tree = BoxTree(rows[order], ids[order], labels, np.ones(len(rows), np.int64), ends)
    low, high = box_bounds(rows[:10], tree.levels[0].low, tree.levels[0].high)
    scores = inner_products(rows[:10], rows[order])
    for i, (start, end) in enumerate(zip(tree.levels[0].start, ends, strict=True)):
        assert (scores[:, start:end] >= low[:, [i]]).all() and (scores[:, start:end] <= high[:, [i]]).all()
    seen = []
    products = tree.products
    tree.products = lambda start, end, *rest: seen.append(end - start) or products(start, end, *rest)
    everything = np.array([[-(2**62), 2**62]])
    found = list(tree.search(rows[:1], np.array([0]), np.array([0]), [everything], 5, same=True))
    expected = sorted(((-int(s), int(order[j])) for j, s in enumerate(scores[0]) if order[j]))[:5]
    assert [(-int(s), int(n)) for s, n in zip(found[0][2], found[0][3], strict=True)] == expected
    assert sum(seen) < len(rows) / 2


def test_products_beyond_double_precision_are_exact():
    a, b = np.array([[2**27, 2**27 - 1, 1]]), np.array([[2**27, 2**27 - 1, 1]])
    assert inner_products(a, b)[0, 0] == 2**54 + (2**27 - 1) ** 2 + 1


def _clustered(rows, k=16, rounds=3):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(usable, key=key)[:k]]
    distance = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c, strict=True))
    for step in range(rounds + 1):
        found = [min((distance(v, c), n) for n, c in enumerate(centroids)) for _, v in usable]
        if step < rounds:
            for n in range(len(centroids)):
                own = [v for (_, v), (_, m) in zip(usable, found, strict=True) if m == n]
                if own:
                    centroids[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    sums = {n: sum(d for d, m in found if m == n) for n in range(len(centroids))}
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted(((i, n, d, sums[n], sum(sums.values()), digest(centroids[n])) for (i, _), (d, n) in zip(usable, found, strict=True)), key=repr)


def _cluster(spark, rows):
    found = cluster_vectors(spark.createDataFrame(rows, SCHEMA))
    picked = found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid_digest())
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def test_clusters_equal_plain_rounds(spark):
    rows = _rows(400, 64, seed=2)
    assert _cluster(spark, rows) == _clustered(rows)


def test_clusters_of_ties_repeats_and_unusable_rows(spark):
    base = _rows(40, 64, seed=3)
    rows = base + base[:10] + [(None, base[0][1], 1), (None, base[1][1], 1)]
    rows += [(1000 + i, [1.0, -1.0] * 32, 0) for i in range(60)] + [(2000 + i, [0.0] * 64, 0) for i in range(20)]
    rows += [(1, None, 1), (2, [1.0] * 63, 1), (3, [1.0] * 65, 1), (4, [], 1), (5, [float("nan")] + [1.0] * 63, 1), (6, [None] + [1.0] * 63, 1), (7, [float("-inf")] + [1.0] * 63, 1)]
    assert _cluster(spark, rows) == _clustered(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = _rows(5, 64, seed=4)
    assert _cluster(spark, rows) == _clustered(rows)
    assert _cluster(spark, []) == [] == _cluster(spark, [(1, [1.0], 1)])


def test_clustering_looks_at_its_own_columns_only(spark):
    table = spark.createDataFrame(_rows(50, 64, seed=6), SCHEMA)
    for name in ("q", "cluster", "distance", "inertia", "centroid", "n", "sums"):
        table = table.withColumn(name, F.lit("x"))
    assert cluster_vectors(table).count() == 50


def test_first_centroids_do_not_depend_on_partitions(spark):
    vectors = integer_vectors(spark.createDataFrame(_rows(100, 64, seed=7), SCHEMA))
    assert (first_centroids(vectors) == first_centroids(vectors.repartition(7))).all()


def test_means_and_deviations_reject_without_missing_the_nearest():
    rng = np.random.default_rng(8)
    # Centroids apart in mean or in deviation only.
    centroids = np.array([np.full(64, 10 * (i // 4)) + (i % 4 * 15) * np.tile([1, -1], 32) for i in range(16)])
    centroids = np.concatenate([centroids, centroids[:3]])
    vectors = centroids[rng.integers(0, 16, 500)] + rng.integers(-3, 4, (500, 64))
    number, distance, computed = MeanOrder.of(centroids).nearest(vectors)
    every = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()
    assert computed < every.size / 4


def test_large_components_are_refused(spark):
    rows = [(1, [3e9] + [0.0] * 63, 1)]
    with pytest.raises(Exception, match="component beyond"):
        _cluster(spark, rows)
