"""The cutting-stock linear program by column generation, for a histogram of lengths."""

from __future__ import annotations

import itertools

import numpy as np


def priced_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within ``capacity`` (unbounded knapsack), as counts per size."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        usable = np.searchsorted(sizes, room, side="right")
        best[room] = best[room - 1]
        if usable:
            gain = best[room - sizes[:usable]] + values[:usable]
            top = int(np.argmax(gain))
            if gain[top] > best[room] + 1e-12:
                best[room], last[room] = gain[top], top
    counts = np.zeros(len(sizes), dtype=np.int64)
    room = capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            counts[last[room]] += 1
            room -= int(sizes[last[room]])
    return float(best[capacity]), counts


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 2e-4, idle: int = 300):
    """``(columns, uses)``: patterns as rows of counts per size, and how often each is cut in whole.

    Starts from patterns of one size, adds the pattern that the knapsack
    prices highest under the dual values, and pivots it into the basis. Ends
    when the dual bound is within ``gap`` of the objective, or when ``idle``
    pivots in a row have not improved it (a degenerate vertex). Uses are rounded
    down, so no size is cut more often than asked for; what is left is less
    than one use of each basic pattern.
    """
    sizes, demand = np.asarray(sizes, dtype=np.int64), np.asarray(demand, dtype=np.float64)
    if not len(sizes):
        return np.zeros((0, 0), dtype=np.int64), np.zeros(0, dtype=np.int64)
    basis = np.diag(capacity // sizes).astype(np.float64)
    inverse = np.linalg.inv(basis)
    uses = inverse @ demand
    best, since = np.inf, 0
    for round_ in itertools.count(1):
        total = float(uses.sum())
        best, since = (total, 0) if total < best * (1 - 1e-9) else (best, since + 1)
        if since > idle:
            break
        duals = inverse.sum(axis=0)
        value, counts = priced_pattern(duals, sizes, capacity)
        if value <= 1 + gap:
            break
        step = inverse @ counts
        able = step > 1e-9
        ratio = np.full(len(step), np.inf)
        ratio[able] = np.maximum(uses[able], 0) / step[able]
        out = int(np.argmin(ratio))
        basis[:, out] = counts
        # The product form of the inverse; built anew now and then against drift.
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        if round_ % 100 == 0:
            inverse = np.linalg.inv(basis)
        uses = inverse @ demand
    whole = np.floor(np.maximum(uses, 0) + 1e-6).astype(np.int64)
    columns = np.rint(basis.T).astype(np.int64)
    # Rounding error must not cut a size more often than it is there.
    while np.any(over := (columns.T @ whole) > demand):
        worst = np.flatnonzero((columns[:, over].sum(axis=1) > 0) & (whole > 0))
        whole[worst[0]] -= 1
    used = whole > 0
    return columns[used], whole[used]
