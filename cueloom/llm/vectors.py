"""Integer vectors for the operators on embeddings: which rows take part, and exact inner products."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest magnitude of an integer component. With it, inner products and squared
#: distances of up to 64 components fit a long integer; a larger one raises.
LARGEST = 1 << 27

#: Whole numbers up to here are exact in double precision.
EXACT = 1 << 53


def has_finite(vector: str) -> Column:
    """Whether a vector is there and each of its components is a finite number."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(F.col(vector).cast("array<double>"), bad), F.lit(False))


def scaled(vector: str, factor: int) -> Column:
    """``floor(factor * x)`` of every component ``x``, taken as double, as ``array<int>``."""

    def whole(x: Column) -> Column:
        value = F.floor(x * F.lit(float(factor)))
        far = F.raise_error(F.concat(F.lit(f"component beyond {LARGEST}: "), value.cast("string")))
        return F.when(F.abs(value) <= LARGEST, value).otherwise(far).cast("int")

    return F.transform(F.col(vector).cast("array<double>"), whole)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact ``left @ right.T`` of integer matrices.

    In double precision where no partial sum can leave its exact range, else in
    64-bit integers.
    """
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    bound = int(np.abs(left).max()) * int(np.abs(right).max()) * left.shape[1]
    if bound < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T
