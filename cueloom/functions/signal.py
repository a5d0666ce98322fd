"""Array functions on one frame of samples; no shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueloom.functions.python import once


@once
@F.arrow_udf(T.ArrayType(T.FloatType()))
def _averaged(samples: pa.Array, channels: pa.Array) -> pa.Array:
    """Interleaved channels averaged, all frames of a batch together by their number of channels."""
    counts = np.maximum(np.asarray(channels.fill_null(1)), 1)
    sizes = np.asarray(samples.value_lengths().fill_null(0))
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    flat = samples.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    steps = sizes // counts
    offsets = np.concatenate(([0], np.cumsum(steps)))
    out = np.empty(offsets[-1], np.float32)
    for count in np.unique(counts):
        rows = np.flatnonzero((counts == count) & (steps > 0))
        total = steps[rows]
        # Place of each averaged sample within its frame.
        inside = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        first = np.repeat(starts[rows], total) + inside * count
        sums = flat[first]
        for channel in range(1, count):
            sums = sums + flat[first + channel]
        out[np.repeat(offsets[rows], total) + inside] = sums / count
    null = samples.is_null().to_numpy(zero_copy_only=False)
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out))
    return lists if not null.any() else pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32), mask=np.append(null, False)), pa.array(out)
    )


def mixdown(samples: Column, channels: Column) -> Column:
    """Interleaved channels averaged to one; an incomplete last group is cut. A mono frame keeps its samples."""
    return _averaged(samples, channels)
