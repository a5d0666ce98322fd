"""Centroid clustering: integer Lloyd rounds with an equal-average equal-variance nearest-centroid search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueloom.llm.common import stored
from cueloom.llm.vectors import has_finite, scaled

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64

# A deviation bound is a difference of square roots in double precision; it only
# rejects a centroid if it exceeds the best distance by more than its rounding.
_ROUNDING = 1e-9


@dataclass
class MeanOrder:
    """Centroids sorted by the sum of their components, with what the inequalities need of each.

    For a vector x and a centroid c of d components with sums s and deviations
    v = |x - mean(x)|: ``|x - c|^2 >= (s_x - s_c)^2 / d + (v_x - v_c)^2``.
    """

    number: np.ndarray
    rows: np.ndarray
    sums: np.ndarray
    deviations: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> MeanOrder:
        sums = centroids.sum(axis=1)
        order = np.lexsort((np.arange(len(sums)), sums))
        return cls(order, centroids[order], sums[order], _deviations(centroids)[order])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid, and how many distances were computed.

        All vectors of the block scan together, each outward from its own mean:
        the unvisited neighbour with the closer mean comes next. A vector is done
        when that neighbour's mean alone puts it beyond the best distance, since
        all that follow are farther. A centroid within the mean bound that the
        deviations reject is passed over. What is left is compared by its exact
        integer distance. Bounds reject only what is strictly farther, so equal
        distances are all seen and the smaller number wins.
        """
        k, d = self.rows.shape
        sums, deviations = vectors.sum(axis=1), _deviations(vectors)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        number = np.full(len(vectors), k, np.int64)
        live, computed = np.arange(len(vectors)), 0
        while len(live):
            lo, hi, own = left[live], right[live], sums[live]
            below = np.where(lo >= 0, own - self.sums[np.maximum(lo, 0)], -1)
            above = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - own, -1)
            down = (above < 0) | ((below >= 0) & (below <= above))
            gap = np.where(down, below, above)
            # In double precision: a square of integer sums may exceed 64 bits.
            apart = gap.astype(np.float64) ** 2 / d
            within = (gap >= 0) & (apart * (1 - _ROUNDING) <= best[live])
            live, place, down, apart = live[within], np.where(down, lo, hi)[within], down[within], apart[within]
            left[live[down]] -= 1
            right[live[~down]] += 1
            spread = (deviations[live] - self.deviations[place]) ** 2
            slack = _ROUNDING * (deviations[live] + self.deviations[place] + 1) ** 2
            near = apart * (1 - _ROUNDING) + spread - slack <= best[live]
            at, place = live[near], place[near]
            difference = vectors[at] - self.rows[place]
            distance = np.einsum("ij,ij->i", difference, difference)
            computed += len(at)
            named = self.number[place]
            better = (distance < best[at]) | ((distance == best[at]) & (named < number[at]))
            best[at[better]], number[at[better]] = distance[better], named[better]
        return number, best, computed


def _deviations(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return np.sqrt(((rows - rows.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))


def integer_vectors(table: DataFrame, vector: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id, q``: rows whose vector has exactly ``dimensions`` components, none null or non-finite.

    ``q`` holds ``floor(64 * x)`` of each. A component beyond ``vectors.LARGEST``
    raises, as its distances would not fit a long integer. Repeated rows and
    rows without an id are kept, each as a row of its own; other columns go.
    """
    whole = (F.size(vector) == dimensions) & has_finite(vector)
    return table.where(F.coalesce(whole, F.lit(False))).select("vec_id", scaled(vector, SCALE).alias("q"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, salt: str = "1") -> np.ndarray:
    """The ``k`` vectors of the smallest sha256 of ``salt:vec_id``, in that order; all if there are fewer.

    Rows without an id come last. Rows of one id are ordered by their components.
    """
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("_key"), "q").orderBy(F.asc_nulls_last("_key"), "q").limit(k).collect()
    return np.array([r["q"] for r in rows], np.int64)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("q"))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: exact ``floor(sum / count)`` of each one's vectors; empty ones stay.

    A task sums its own vectors, so at most one row a task and centroid is shuffled.
    """
    k, d = centroids.shape
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder.of(shared.value)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for batch in batches:
            rows = _matrix(batch)
            if len(rows):
                number = order.nearest(rows)[0]
                counts += np.bincount(number, minlength=k)
                np.add.at(sums, number, rows)
        there = np.flatnonzero(counts)
        columns = [pa.array(there, pa.int32()), pa.array(counts[there])]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(list(sums[there]), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    parts = vectors.select("q").mapInArrow(run, "cluster int, n long, sums array<long>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(d)])
    moved = centroids.copy()
    for row in total.collect():  # at most one row a centroid
        moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(d)]
    return moved


def _assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder.of(shared.value)
        for batch in batches:
            if batch.num_rows:
                number, distance, _ = order.nearest(_matrix(batch))
                ids = batch.column(batch.schema.get_field_index("vec_id"))
                columns = [ids, pa.array(number, pa.int32()), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster_vectors(
    table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, vector: str = "embedding", salt: str = "1"
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector that takes part.

    Lloyd rounds over all vectors, in whole numbers, so the result is the same
    for every partitioning and rerun. ``centroid`` is the final one, of which
    there are ``k``. An empty table, or one without a usable vector, gives no row.
    """
    vectors = stored(integer_vectors(table, vector), "cluster-vectors")
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        return _assigned(vectors.limit(0), np.zeros((1, DIMENSIONS), np.int64)).select(
            "*",
            F.lit(0).cast("long").alias("cluster_inertia"),
            F.lit(0).cast("long").alias("inertia"),
            F.array().cast("array<long>").alias("centroid"),
        )
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    found = stored(_assigned(vectors, centroids), "cluster-rows")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    spark = table.sparkSession
    rows = [(n, sums.get(n, 0), sum(sums.values()), [int(x) for x in c]) for n, c in enumerate(centroids)]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(about), "cluster").select(  # one row a centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def centroid_digest(centroid: str = "centroid") -> Column:
    return F.sha2(F.array_join(F.col(centroid).cast("array<string>"), ","), 256)
