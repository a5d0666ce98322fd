"""A packed R-tree over the vectors of one tile, and the best-first search for inner products in windows."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

from cueloom.llm.vectors import EXACT, inner_products

#: Rows of a leaf, and children of an inner node.
LEAF = 128
FANOUT = 16

_NONE_YET = np.iinfo(np.int64).min
_LAST_ID = np.iinfo(np.int64).max


def tile_order(rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Sort-tile-recursive packing: an order of the rows, and where each leaf ends in it.

    Leaves hold one label. A label's rows are cut into slabs along the first
    coordinate, each slab along the next, and so on: as many slabs on each of the
    coordinates left as make leaves of ``leaf`` rows in the end.
    """
    order, ends = [], []

    def pack(index: np.ndarray, coordinate: int) -> None:
        pages = -(-len(index) // leaf)
        left = rows.shape[1] - coordinate
        if pages <= 1 or left <= 0:
            for at in range(0, len(index), leaf):
                order.append(index[at : at + leaf])
                ends.append(len(order[-1]))
            return
        slabs = int(np.ceil(pages ** (1 / left) - 1e-9))
        index = index[np.lexsort((ids[index], rows[index, coordinate]))]
        size = -(-pages // max(slabs, 1)) * leaf
        for at in range(0, len(index), size):
            pack(index[at : at + size], coordinate + 1)

    for label in np.unique(labels):
        pack(np.flatnonzero(labels == label), 0)
    return np.concatenate(order or [np.zeros(0, np.int64)]), np.cumsum(ends, dtype=np.int64)


def box_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any point of each box, coordinate by coordinate."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return (
        inner_products(up, low) + inner_products(down, high),
        inner_products(up, high) + inner_products(down, low),
    )


@dataclass
class _Level:
    """Boxes of one level; node i covers rows ``start[i]`` to ``end[i]`` and nodes FANOUT * i … of the level below."""

    low: np.ndarray
    high: np.ndarray
    start: np.ndarray
    end: np.ndarray
    least_label: np.ndarray
    most_label: np.ndarray
    least_id: np.ndarray

    def above(self) -> _Level:
        at = np.arange(0, len(self.start), FANOUT)
        last = np.append(at[1:], len(self.start)) - 1
        return _Level(
            np.minimum.reduceat(self.low, at),
            np.maximum.reduceat(self.high, at),
            self.start[at],
            self.end[last],
            np.minimum.reduceat(self.least_label, at),
            np.maximum.reduceat(self.most_label, at),
            np.minimum.reduceat(self.least_id, at),
        )


class BoxTree:
    """Rows in packed order. ``ids`` of rows without one are ``_LAST_ID``, so that they come last among ties."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray, ends: np.ndarray):
        self.rows, self.ids, self.labels, self.copies = rows, ids, labels, copies
        self.doubles, self.largest = rows.astype(np.float64), int(np.abs(rows).max(initial=0))
        start = np.concatenate(([0], ends[:-1]))
        reduced = lambda f, x: f.reduceat(x, start)
        level = _Level(
            reduced(np.minimum, rows),
            reduced(np.maximum, rows),
            start,
            ends,
            reduced(np.minimum, labels),
            reduced(np.maximum, labels),
            reduced(np.minimum, ids),
        )
        self.levels = [level]
        while len(self.levels[-1].start) > FANOUT:
            self.levels.append(self.levels[-1].above())

    def products(self, start: int, end: int, anchor: np.ndarray, exact: bool) -> np.ndarray:
        """Inner products of some rows, in double precision if that is ``exact``."""
        if exact:
            return (self.doubles[start:end] @ anchor.astype(np.float64)).astype(np.int64)
        return self.rows[start:end].astype(np.int64) @ anchor.astype(np.int64)

    def search(self, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, windows: list[np.ndarray], most: int, same: bool):
        """For each anchor and each of its windows, the first ``most`` rows whose score lies in the window.

        ``windows[i]`` has a row (lowest, highest score) for each window of anchor
        i. With ``same`` only rows of the anchor's label count, the anchor's own
        row not among them (one copy of it); else only rows of other labels.
        Yields ``(anchor, window, scores, ids)``, best first, a row with several
        copies as often as it has them.
        """
        bounds = [box_bounds(anchors, level.low, level.high) for level in self.levels]
        for i in range(len(anchors)):
            queue = _Queue(self, anchors[i], ids[i], labels[i], windows[i], most, same)
            found = queue.run([(low[i], high[i]) for low, high in bounds])
            for w, (scores, names) in enumerate(found):
                if len(scores):
                    yield i, w, scores, names


class _Queue:
    """Best-first search of one anchor: boxes by falling upper bound, all its windows in one pass."""

    def __init__(self, tree: BoxTree, anchor: np.ndarray, own: int, label: int, windows: np.ndarray, most: int, same: bool):
        self.tree, self.anchor, self.own, self.label, self.most, self.same = tree, anchor, own, label, most, same
        self.lowest, self.highest = windows[:, 0], windows[:, 1]
        count = len(windows)
        self.exact = tree.largest * int(np.abs(anchor).max(initial=0)) * max(len(anchor), 1) < EXACT
        # Score and id of the last row that still belongs to a full window's result.
        self.last_score = np.full(count, _NONE_YET)
        self.last_id = np.full(count, _LAST_ID)
        self.scores = [np.zeros(0, np.int64)] * count
        self.names = [np.zeros(0, np.int64)] * count

    def open(self, low: np.ndarray, high: np.ndarray, level: _Level, nodes: np.ndarray) -> np.ndarray:
        """Which boxes may still hold a result.

        Rejected are boxes outside every window, strictly below the last row of
        every window, equal to it with larger ids only, or without a right label.
        """
        least, most = level.least_label[nodes], level.most_label[nodes]
        labelled = (least <= self.label) & (most >= self.label)
        if not self.same:
            labelled = (least != self.label) | (most != self.label)
        low, high, name = low[nodes, None], high[nodes, None], level.least_id[nodes, None]
        meets = (high >= self.lowest) & (low <= self.highest)
        better = (high > self.last_score) | ((high == self.last_score) & (name <= self.last_id))
        return labelled & (meets & better).any(axis=1)

    def run(self, bounds: list[tuple[np.ndarray, np.ndarray]]):
        levels, heap = self.tree.levels, []

        def push(depth: int, nodes: np.ndarray) -> None:
            low, high = bounds[depth]
            for node in nodes[self.open(low, high, levels[depth], nodes)].tolist():
                heapq.heappush(heap, (-int(high[node]), int(levels[depth].least_id[node]), depth, node))

        top = len(levels) - 1
        push(top, np.arange(len(levels[top].start)))
        while heap:
            _, _, depth, node = heapq.heappop(heap)
            level, alone = levels[depth], np.array([node])
            if not self.open(*bounds[depth], level, alone)[0]:
                continue
            if depth == 0:
                self.score(level.start[node], level.end[node])
                continue
            below = np.arange(node * FANOUT, min((node + 1) * FANOUT, len(levels[depth - 1].start)))
            low, high = bounds[depth - 1]
            # Leaves of one node lie together: if none is rejected, one product scores them all.
            if depth == 1 and self.open(low, high, levels[0], below).all():
                self.score(level.start[node], level.end[node])
            else:
                push(depth - 1, below)
        return list(zip(self.scores, self.names, strict=True))

    def score(self, start: int, end: int) -> None:
        tree = self.tree
        scores = tree.products(start, end, self.anchor, self.exact)
        right = (tree.labels[start:end] == self.label) == self.same
        for w in range(len(self.lowest)):
            inside = right & (scores >= max(self.lowest[w], self.last_score[w])) & (scores <= self.highest[w])
            at = np.flatnonzero(inside)
            if len(at) > self.most:
                # The score that the `most`-th of them reaches; equal ones stay for the ids to decide.
                least = np.partition(scores[at], len(at) - self.most)[len(at) - self.most]
                if self._suffice(at[scores[at] >= least] + start):
                    at = at[scores[at] >= least]
            if len(at):
                self.take(w, scores[at], at + start)

    def _suffice(self, rows: np.ndarray) -> bool:
        """Whether these rows fill a window without the anchor's own row, if it is among them."""
        own = int(self._own(rows).sum()) if self.same else 0
        return int(self.tree.copies[rows].sum()) - own >= self.most

    def _own(self, rows: np.ndarray) -> np.ndarray:
        """Which rows are the anchor's own one (equal id, label and components)."""
        named = self.tree.ids[rows] == self.own
        if named.any():
            named[named] = (self.tree.rows[rows[named]] == self.anchor).all(axis=1)
        return named

    def take(self, w: int, scores: np.ndarray, rows: np.ndarray) -> None:
        copies = self.tree.copies[rows] - (self._own(rows) if self.same else 0)
        copies = np.minimum(copies, self.most)
        scores = np.concatenate((self.scores[w], np.repeat(scores, copies)))
        names = np.concatenate((self.names[w], np.repeat(self.tree.ids[rows], copies)))
        first = np.lexsort((names, -scores))[: self.most]
        self.scores[w], self.names[w] = scores[first], names[first]
        if len(first) == self.most:
            self.last_score[w], self.last_id[w] = scores[first[-1]], names[first[-1]]
