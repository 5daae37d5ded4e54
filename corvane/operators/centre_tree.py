"""Exact nearest-centre search in a ball tree over the centres."""

from __future__ import annotations

import numpy as np

# Centres of a leaf, points that go down the tree together, the share of all distances above which a tree does not
# pay, and steps that move two cluster means before a ball is split.
LEAF = 64
BLOCK = 1 << 14
WORTH = 0.25
SPLIT_STEPS = 4


class CentreTree:
    """Balls around clusters of clusters of the centres.

    A point is first measured in the leaf whose ball centres draw it down, then
    goes down again into every ball that the triangle inequality does not rule
    out: a centre in a ball of radius r around p is at least d(x, p) - r away.
    Bounds leave room for rounding, and centres that rounding cannot tell apart
    are measured exactly, so index and ties equal those of a plain search.

    ``evaluated`` counts measured distances, to ball centres included. Where a
    block needs more than ``WORTH`` of all of them, the tree reports ``plain``.
    """

    def __init__(self, centres: np.ndarray, leaf: int = LEAF):
        self.centres = np.ascontiguousarray(centres, dtype=np.float64)
        self.evaluated = 0
        self.plain = False
        order = np.arange(len(self.centres))
        pivots, self.radius, self.span, self.children = [], [], [], []
        waiting = [(0, len(order), -1)]
        while waiting:
            start, stop, parent = waiting.pop()
            rows = self.centres[order[start:stop]]
            pivot = rows.mean(axis=0)
            apart = np.sqrt(((rows - pivot) ** 2).sum(axis=1))
            node = len(pivots)
            pivots.append(pivot)
            self.radius.append(float(apart.max()) * (1 + 1e-9))
            self.span.append((start, stop))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if stop - start > leaf and self.radius[-1] > 0:
                left = _halves(rows, apart)
                middle = start + int(left.sum())
                order[start:stop] = order[start:stop][np.argsort(~left, kind="stable")]
                waiting += [(start, middle, node), (middle, stop, node)]
        self.order, self.pivots = order, np.array(pivots)
        self._derive()

    def _derive(self) -> None:
        sorted_ = self.centres[self.order]
        self.twice = np.ascontiguousarray(-2.0 * sorted_.T)
        self.norms = (sorted_ * sorted_).sum(axis=1)
        self.pivot_norms = (self.pivots * self.pivots).sum(axis=1)
        self.starts = np.array([start for start, _ in self.span])

    def __getstate__(self) -> dict:
        # What follows from the rest is worked out again where the tree arrives.
        return {k: v for k, v in self.__dict__.items() if k not in ("twice", "norms", "pivot_norms", "starts")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._derive()

    def search(self, x: np.ndarray, margin: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """``(index, margin)`` per row, as :func:`corvane.operators.nearest.nearest_margin`; margin only if asked for."""
        if x.shape[1] != self.centres.shape[1]:
            raise ValueError(f"points have {x.shape[1]} coordinates, centres {self.centres.shape[1]}")
        index = np.zeros(len(x), dtype=np.int32)
        apart = np.zeros(len(x)) if margin else None
        for at in range(0, len(x), BLOCK):
            found = _Block(self, x[at : at + BLOCK], margin)
            index[at : at + BLOCK] = found.index()
            if margin:
                apart[at : at + BLOCK] = found.margin()
            self.evaluated += found.evaluated
            if found.evaluated > WORTH * len(found.x) * len(self.centres):
                self.plain = True
        return index, apart


def _halves(rows: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Which rows belong to the first of two clusters, seeded by two far rows; neither is empty or tiny."""
    one = rows[int(apart.argmax())]
    other = rows[int(((rows - one) ** 2).sum(axis=1).argmax())]
    for _ in range(SPLIT_STEPS):
        along = rows @ (other - one)
        left = along <= 0.5 * ((other * other).sum() - (one * one).sum())
        if not len(rows) // 16 < left.sum() < len(rows) - len(rows) // 16:
            # A lopsided split would make the tree deep; the median does not.
            left = np.zeros(len(rows), dtype=bool)
            left[np.argpartition(along, len(rows) // 2)[: len(rows) // 2]] = True
            return left
        one, other = rows[left].mean(axis=0), rows[~left].mean(axis=0)
    return left


class _Block:
    """The search for some points."""

    def __init__(self, tree: CentreTree, x: np.ndarray, second: bool):
        self.tree, self.x, self.second = tree, x, second
        self.evaluated = 0
        self.own = np.einsum("ij,ij->i", x, x)
        # Squared distances from the product are off by no more than this.
        self.error = 16 * (x.shape[1] + 4) * np.finfo(np.float64).eps * (self.own + tree.norms.max())
        self.low = np.full(len(x), np.inf)
        self.next = np.full(len(x), np.inf)
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        home = self._homes()
        for leaf in np.unique(home):
            self._measure(int(leaf), np.flatnonzero(home == leaf))
        self._descend(home)

    def _apart(self, rows: np.ndarray, node: int) -> np.ndarray:
        """Squared distances to a ball's centre, less the points' own squares."""
        self.evaluated += len(rows)
        return self.x[rows] @ (-2.0 * self.tree.pivots[node]) + self.tree.pivot_norms[node]

    def _homes(self) -> np.ndarray:
        """The leaf of every point whose ball centres are nearest on the way down."""
        home = np.zeros(len(self.x), dtype=np.int64)
        waiting = [(0, np.arange(len(self.x)))]
        while waiting:
            node, rows = waiting.pop()
            home[rows] = node
            if self.tree.children[node] and len(rows):
                one, two = self.tree.children[node]
                first = self._apart(rows, one) <= self._apart(rows, two)
                waiting += [(one, rows[first]), (two, rows[~first])]
        return home

    def _descend(self, home: np.ndarray) -> None:
        waiting = [(0, np.arange(len(self.x)))]
        while waiting:
            node, rows = waiting.pop()
            # What was found since the node was put off may rule it out by now.
            rows = rows[self._open(rows, node)] if node else rows
            if not len(rows):
                continue
            if self.tree.children[node]:
                # The child that is home to more of the points is looked at first.
                lot = sorted(self.tree.children[node], key=lambda c: np.count_nonzero(self._inside(home[rows], c)))
                waiting += [(child, rows) for child in lot]
            else:
                self._measure(node, rows[home[rows] != node])

    def _inside(self, homes: np.ndarray, node: int) -> np.ndarray:
        start, stop = self.tree.span[node]
        at = self.tree.starts[homes]
        return (at >= start) & (at < stop)

    def _open(self, rows: np.ndarray, node: int) -> np.ndarray:
        error = self.error[rows]
        ball = np.sqrt(np.maximum(self._apart(rows, node) + self.own[rows] - error, 0)) - self.tree.radius[node]
        known = (self.next if self.second else self.low)[rows] + self.own[rows]
        return (ball <= 0) | (ball * ball <= known + 2 * error)

    def _measure(self, leaf: int, rows: np.ndarray) -> None:
        if not len(rows):
            return
        start, stop = self.tree.span[leaf]
        rough = self.x[rows] @ self.tree.twice[:, start:stop]
        rough += self.tree.norms[start:stop]
        self.evaluated += rough.size
        best = rough.min(axis=1)
        if self.second:
            two = np.partition(rough, 1, axis=1)[:, 1] if stop - start > 1 else np.full(len(rows), np.inf)
            # The second of all is the smaller of both seconds and the larger first.
            self.next[rows] = np.minimum(np.minimum(self.next[rows], two), np.maximum(self.low[rows], best))
        self.low[rows] = np.minimum(self.low[rows], best)
        row, column = np.nonzero(rough <= (self.low[rows] + self.error[rows])[:, None])
        self.pairs.append((rows[row], self.tree.order[start + column], rough[row, column]))

    def _close(self) -> tuple[np.ndarray, np.ndarray]:
        row, cid, rough = (np.concatenate(c) for c in zip(*self.pairs, strict=True))
        near = rough <= self.low[row] + self.error[row]
        return row[near], cid[near]

    def index(self) -> np.ndarray:
        row, cid = self._close()
        exact = np.zeros(len(row))
        tied = np.bincount(row, minlength=len(self.x))[row] > 1
        for j in range(self.x.shape[1]) if tied.any() else ():
            step = self.x[row[tied], j] - self.tree.centres[cid[tied], j]
            exact[tied] += step * step
        order = np.lexsort((cid, exact, row))
        found, first = np.unique(row[order], return_index=True)
        out = np.zeros(len(self.x), dtype=np.int32)
        out[found] = cid[order[first]]
        return out

    def margin(self) -> np.ndarray:
        """How much farther the second centre is than the nearest; 0 where rounding could not tell them apart."""
        far = np.sqrt(np.maximum(self.next + self.own - self.error, 0))
        out = far - np.sqrt(np.maximum(self.low + self.own + self.error, 0))
        out[self.next <= self.low + self.error] = 0
        return out
