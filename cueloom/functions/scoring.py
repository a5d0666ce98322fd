"""Word-level edit distance and its substitution, deletion, insertion split."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueloom.functions.python import once

EDIT_COUNTS_TYPE = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("edits", "substitutions", "deletions", "insertions", "hits")]
)

# Costs pack (edits, deletions) in one integer, so the minimum is the fewest
# edits and, among those, the fewest deletions.
_BITS = 32
_EDIT = 1 << _BITS
_DELETION = _EDIT + 1
_FAR = 1 << 62

# Pairs of fewer words than this, both sides together, fit a 32-bit packing.
_SHORT_BITS = 15
_SHORT_WORDS = 1 << _SHORT_BITS

# Cells of one vectorised step, and of one pair above which it is banded alone.
_STEP_CELLS = 1 << 15
_LONE_PAIR_CELLS = 1 << 20

# Words of a side up to which a pair is aligned by bit sets of that size.
_BIT_WORDS = 1 << 12


def _distance(left: list[int], right: list[int]) -> int:
    """Fewest edits between two code lists: a whole row of the alignment table in a few operations on big integers.

    A row is kept as two bit sets, the places where the cost rises and where it
    falls by one against the place before (Myers; Hyyro for whole strings).
    """
    if len(left) < len(right):
        left, right = right, left
    start, end = 0, len(right)
    while start < end and left[start] == right[start]:
        start += 1
    shift = len(left) - end
    while end > start and left[end - 1 + shift] == right[end - 1]:
        end -= 1
    left, right = left[start : end + shift], right[start:end]
    if not right:
        return len(left)
    there: dict[int, int] = dict.fromkeys(right, 0)
    for i, code in enumerate(left):
        if code in there:
            there[code] |= 1 << i
    every, last, cost = (1 << len(left)) - 1, 1 << (len(left) - 1), len(left)
    rises, falls = every, 0
    for code in right:
        equal = there[code]
        vertical = equal | falls
        horizontal = (((equal & rises) + rises) ^ rises) | equal
        up = (falls | ~(horizontal | rises)) & every
        down = rises & horizontal
        cost += 1 if up & last else -1 if down & last else 0
        up, down = (up << 1) | 1, down << 1
        rises = (down | ~(vertical | up)) & every
        falls = up & vertical & every
    return cost


@once
@F.arrow_udf(T.LongType())
def _edit_distance(reference: pa.Array, hypothesis: pa.Array) -> pa.Array:
    codes, ref_at, hyp_at = _coded(reference, hypothesis)
    ref, hyp = codes[: ref_at[-1]], codes[ref_at[-1] :]
    ref_list, hyp_list = ref.tolist(), hyp.tolist()
    found = []
    for i, null in enumerate(pc.or_(reference.is_null(), hypothesis.is_null()).to_pylist()):
        a, b, c, d = ref_at[i], ref_at[i + 1], hyp_at[i], hyp_at[i + 1]
        if null:
            found.append(None)
        elif max(b - a, d - c) <= _BIT_WORDS:
            found.append(_distance(ref_list[a:b], hyp_list[c:d]))
        else:
            found.append(_banded_cost(ref[a:b], hyp[c:d]) >> _BITS)
    return pa.array(found, pa.int64())


def edit_distance(reference: Column, hypothesis: Column) -> Column:
    """Fewest word edits between two word arrays of any length; null if either is null.

    Words become numbers, and pairs of up to _BIT_WORDS words a side are aligned
    by operations on bit sets, longer ones in a widening band.
    """
    return _edit_distance(reference, hypothesis)


def _padded_costs(ref: np.ndarray, hyp: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Packed cost of every pair of a padded block; rows are sorted by ``n``."""
    width = hyp.shape[1]
    short = ref.shape[1] + width < _SHORT_WORDS
    bits, kind = (_SHORT_BITS, np.int32) if short else (_BITS, np.int64)
    edit, deletion = kind(1 << bits), kind((1 << bits) + 1)
    ramp = np.arange(width + 1, dtype=kind) * edit
    row = np.broadcast_to(ramp, (len(n), width + 1)).copy()
    costs = np.where(n == 0, m << bits, 0)
    done = int(np.searchsorted(n, 0, side="right"))
    for i in range(ref.shape[1]):
        row = row[max(done - (len(n) - len(row)), 0) :]
        live = slice(len(n) - len(row), None)
        diagonal = (hyp[live] != ref[live, i : i + 1]) * edit
        diagonal += row[:, :-1]
        row = row + deletion
        np.minimum(row[:, 1:], diagonal, out=row[:, 1:])
        row -= ramp
        np.minimum.accumulate(row, axis=1, out=row)
        row += ramp
        ended = int(np.searchsorted(n, i + 1, side="right"))
        if ended > done:
            pick = np.arange(done, ended)
            costs[pick] = row[pick - live.start, m[pick]]
            done = ended
    return (costs >> bits << _BITS) + (costs & ((1 << bits) - 1))


def _banded_cost(ref: np.ndarray, hyp: np.ndarray) -> int:
    """Packed cost of one long pair, widening the band until it is provably enough.

    An alignment of ``e`` edits never leaves the diagonal by more than ``e``, so
    a result of at most ``band`` edits is the optimum.
    """
    n, m = len(ref), len(hyp)
    band = max(abs(n - m), 64)
    while True:
        band = min(band, max(n, m))
        ramp = np.arange(2 * band + 1, dtype=np.int64) * _EDIT
        padded = np.full(n + m + 3 * band + 2, -1, dtype=np.int64)
        padded[band + 1 : band + 1 + m] = hyp
        column = np.arange(-band, band + 1)
        row = np.where((column >= 0) & (column <= m), column * _EDIT, _FAR)
        for i in range(1, n + 1):
            step = np.where(padded[i : i + 2 * band + 1] != ref[i - 1], _EDIT, 0)
            step += row
            np.minimum(step[:-1], row[1:] + _DELETION, out=step[:-1])
            step -= ramp
            row = np.minimum.accumulate(step) + ramp
            column += 1
            row[(column < 0) | (column > m)] = _FAR
        cost = int(row[m - n + band])
        if cost >> _BITS <= band or band >= max(n, m):
            return cost
        band *= 2


def _pair_costs(ref: np.ndarray, ref_at: np.ndarray, hyp: np.ndarray, hyp_at: np.ndarray) -> np.ndarray:
    """Packed cost of each pair, given word codes and list offsets of both sides."""
    n, m = np.diff(ref_at), np.diff(hyp_at)
    costs = np.zeros(len(n), dtype=np.int64)
    lone = n * m > _LONE_PAIR_CELLS
    for p in np.flatnonzero(lone):
        costs[p] = _banded_cost(ref[ref_at[p] : ref_at[p + 1]], hyp[hyp_at[p] : hyp_at[p + 1]])
    rest = np.flatnonzero(~lone)
    rest = rest[np.lexsort((m[rest], n[rest]))]
    start = 0
    while start < len(rest):
        widest = np.maximum.accumulate(m[rest[start : start + _STEP_CELLS]]) + 1
        room = widest * np.arange(1, len(widest) + 1) <= _STEP_CELLS
        block = rest[start : start + max(int(room.sum()), 1)]
        start += len(block)
        costs[block] = _padded_costs(
            _padded(ref, ref_at, block, -1), _padded(hyp, hyp_at, block, -2), n[block], m[block]
        )
    return costs


def _padded(values: np.ndarray, offsets: np.ndarray, block: np.ndarray, filler: int) -> np.ndarray:
    sizes = offsets[block + 1] - offsets[block]
    column = np.arange(int(sizes.max(initial=0)))
    inside = column < sizes[:, None]
    out = np.full(inside.shape, filler, dtype=values.dtype)
    out[inside] = values[(offsets[block][:, None] + column)[inside]]
    return out


def _coded(reference: pa.Array, hypothesis: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers for the words of both sides, one after the other, and the list offsets of each."""
    words = pa.concat_arrays([reference.flatten(), hypothesis.flatten()]).dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False)
    sizes = [np.asarray(side.value_lengths().fill_null(0)) for side in (reference, hypothesis)]
    ref_at, hyp_at = (np.concatenate(([0], np.cumsum(s))).astype(np.int64) for s in sizes)
    return codes, ref_at, hyp_at


@once
@F.arrow_udf(EDIT_COUNTS_TYPE)
def _edit_counts(reference: pa.Array, hypothesis: pa.Array) -> pa.Array:
    codes, ref_at, hyp_at = _coded(reference, hypothesis)
    cost = _pair_costs(codes[: ref_at[-1]], ref_at, codes[ref_at[-1] :], hyp_at)
    n, m = np.diff(ref_at), np.diff(hyp_at)
    edits, deletions = cost >> _BITS, cost & (_EDIT - 1)
    insertions = deletions - n + m
    substitutions = edits - deletions - insertions
    fields = {
        "edits": edits,
        "substitutions": substitutions,
        "deletions": deletions,
        "insertions": insertions,
        "hits": n - substitutions - deletions,
    }
    return pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in fields.values()], list(fields))


def edit_counts(reference: Column, hypothesis: Column) -> Column:
    """Edits, substitutions, deletions, insertions and hits of each pair of word arrays.

    The split is the one with the fewest edits and then the fewest deletions.
    Pairs of an Arrow batch are aligned together, long ones in a widening band.
    """
    return _edit_counts(reference, hypothesis)
