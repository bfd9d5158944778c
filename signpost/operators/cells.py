"""Cells of unit vectors around centers, and which of them can hold a near neighbour.

With the angle as distance the triangle inequality holds: a query whose angle to a center exceeds
the cell's radius by more than the angle of its k-th best so far has no better one in that cell.
Centers only decide how much is left out, never what is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MOST_CELLS = 1024
# Vectors that the centers are fitted on, for each cell.
SAMPLE_A_CELL = 16
_ROUNDS = 4
_ROWS = 1 << 11
# Scores are compared after rounding, and unit vectors are so in single precision.
_MARGIN = 1e-5


def cell_count(n: int) -> int:
    return max(1, min(MOST_CELLS, math.isqrt(n)))


def fit_centers(sample: np.ndarray, count: int) -> np.ndarray:
    """At most `count` unit vectors in the middle of the sample's clusters."""
    start = np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(np.int64)
    centers = sample[start].copy()
    for _ in range(_ROUNDS):
        nearest = np.concatenate([(part @ centers.T).argmax(axis=1) for part in _parts(sample)])
        order = np.argsort(nearest, kind="stable")
        used, first = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(sample[order], first, axis=0)
        norms = np.linalg.norm(sums, axis=1)
        centers[used[norms > 0]] = sums[norms > 0] / norms[norms > 0, None]
    return centers


def nearest_center(unit: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each vector's nearest center, and their cosine."""
    cells, cosines = [np.empty(0, np.int64)], [np.empty(0, np.float32)]
    for part in _parts(unit):
        scores = part @ centers.T
        cells.append(scores.argmax(axis=1))
        cosines.append(scores[np.arange(len(part)), cells[-1]])
    return np.concatenate(cells), np.concatenate(cosines)


def _parts(rows: np.ndarray) -> Iterator[np.ndarray]:
    return (rows[s : s + _ROWS] for s in range(0, len(rows), _ROWS))


def _pack(centers: np.ndarray, counts: np.ndarray, limit: int) -> list[np.ndarray]:
    """Cells in groups of at most `limit` members, near ones together; a larger cell is its own group."""
    groups, todo = [], [np.flatnonzero(counts)]
    while todo:
        cells = todo.pop()
        if len(cells) <= 1 or counts[cells].sum() <= limit:
            groups += [cells] if len(cells) else []
            continue
        around = centers[cells] - centers[cells].mean(axis=0)
        order = cells[np.argsort(around @ np.linalg.svd(around, full_matrices=False)[2][0], kind="stable")]
        below = np.cumsum(counts[order])
        cut = min(max(1, int(np.searchsorted(below, below[-1] / 2))), len(cells) - 1)
        todo += [order[cut:], order[:cut]]
    return groups


class Cells:
    """Cells cut into blocks, and these put into groups of at most `limit` members.

    `counts` and `nearest` are each cell's members and their least cosine to its center. Blocks are
    numbered group by group.
    """

    def __init__(self, centers: np.ndarray, counts: np.ndarray, nearest: np.ndarray, limit: int):
        self.centers = centers
        # Error bound of a dot product in single precision.
        self.error = 1.1 * (centers.shape[1] + 2) * 2.0**-24 + 1e-6
        self.radius = np.arccos(np.clip(nearest - self.error, -1.0, 1.0))
        self.blocks = np.maximum(1, -(-counts // limit))
        self.first = np.zeros(len(centers), np.int64)
        cell, group, groups = [], [], 0
        for members in _pack(centers, counts, limit):
            for c in members:
                self.first[c] = len(cell)
                cell += [c] * self.blocks[c]
                # The blocks of a cut cell are a group each.
                group += [groups + b for b in range(self.blocks[c])]
            groups = group[-1] + 1
        self.cell, self.group = np.array(cell, np.int64), np.array(group, np.int64)
        self.members = -(-counts[self.cell] // self.blocks[self.cell])

    @property
    def dim(self) -> int:
        return self.centers.shape[1]

    def block_of(self, cells: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.first[cells] + rows % self.blocks[cells]

    def home(self, unit: np.ndarray, rows: np.ndarray, k: int) -> Iterator[np.ndarray]:
        """For parts of the queries, which blocks each meets first.

        One of its nearest cell, or where that has few members the blocks of its group.
        """
        empty = np.ones(len(self.centers), bool)
        empty[self.cell] = False
        for s in range(0, len(unit), _ROWS):
            scores = unit[s : s + _ROWS] @ self.centers.T
            scores[:, empty] = -np.inf
            yield from self.home_of(self.block_of(scores.argmax(axis=1), rows[s : s + _ROWS]), k)

    def home_of(self, block: np.ndarray, k: int) -> Iterator[np.ndarray]:
        """What the queries of these blocks meet first."""
        for s in range(0, len(block), _ROWS):
            part = block[s : s + _ROWS]
            meets = np.zeros((len(part), len(self.cell)), bool)
            meets[np.arange(len(part)), part] = True
            small = np.flatnonzero(self.members[part] <= k)
            meets[small] = self.group[part[small]][:, None] == self.group
            yield meets

    def further(self, unit: np.ndarray, floor: np.ndarray) -> Iterator[np.ndarray]:
        """Which blocks may hold one that reaches `floor`, each query's k-th cosine so far."""
        limit = np.arccos(np.clip(floor - _MARGIN, -1.0, 1.0))
        for s in range(0, len(unit), _ROWS):
            scores = (unit[s : s + _ROWS] @ self.centers.T).astype(np.float64)
            angle = np.arccos(np.clip(scores + self.error, -1.0, 1.0))
            # What is no number is not left out.
            yield (~(angle - self.radius > limit[s : s + _ROWS, None]))[:, self.cell]

    def lists(self, at: np.ndarray, meets: np.ndarray, n: int) -> pa.Array:
        """The blocks of rows `at` of n as Arrow lists of (group_no, blocks, work); null for other rows."""
        row, block = np.nonzero(meets)
        group = self.group[block]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (group[1:] != group[:-1])
        start = np.flatnonzero(new)
        blocks = pa.ListArray.from_arrays(
            pa.array(np.append(start, len(row)).astype(np.int32)), pa.array(block.astype(np.int32))
        )
        work = np.add.reduceat(self.members[block], start) if len(start) else np.empty(0, np.int64)
        entries = pa.StructArray.from_arrays(
            [pa.array(group[start].astype(np.int32)), blocks, pa.array(work.astype(np.int64))],
            names=["group_no", "blocks", "work"],
        )
        counts, known = np.zeros(n, np.int64), np.zeros(n, bool)
        counts[at], known[at] = np.bincount(row[start], minlength=len(at)), True
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), entries, mask=pa.array(~known))
