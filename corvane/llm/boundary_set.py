"""A set of positions in containers of 65,536, with cumulative cardinalities.

Positions with the same high bits share a container, which is the smallest of
three forms: a sorted array of 16-bit values, a bitmap of 65,536 bits, or runs
of consecutive values. ``select(k)`` searches the cumulative cardinalities for
the container and selects inside it.

Here the positions are the byte offsets at which the code points of a UTF-8
text begin, and its end: ``select`` turns a number of code points into the byte
at which to cut. Plain ASCII is a single run for each container, 4 bytes.
"""

from __future__ import annotations

import numpy as np

SPAN = 1 << 16
#: Forms of a container.
ARRAY, BITMAP, RUN = 0, 1, 2


class BoundarySet:
    """Ascending distinct non-negative positions."""

    def __init__(self, positions: np.ndarray):
        positions = np.asarray(positions, dtype=np.int64)
        if len(positions) and (positions[0] < 0 or np.any(positions[1:] <= positions[:-1])):
            raise ValueError("positions must be ascending, distinct and not negative")
        high = positions >> 16
        starts = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[starts]
        self.before = np.append(starts, len(positions))
        self.containers = [
            _container((positions[a:b] & (SPAN - 1)).astype(np.uint16)) for a, b in zip(starts, self.before[1:], strict=True)
        ]

    @classmethod
    def of_text(cls, raw: bytes) -> BoundarySet:
        """Where the code points of UTF-8 text begin, and its end; made container by container."""
        made = cls(np.zeros(0, dtype=np.int64))
        counts = [0]
        data = np.frombuffer(raw, dtype=np.uint8)
        for at in range(0, len(raw) + 1, SPAN):
            part = data[at : at + SPAN]
            low = np.flatnonzero((part & 0xC0) != 0x80) if not raw.isascii() else np.arange(len(part))
            if len(raw) - at < SPAN:
                low = np.append(low, len(raw) - at)
            made.containers.append(_container(low.astype(np.uint16)))
            counts.append(len(low))
        made.keys = np.arange(len(made.containers))
        made.before = np.cumsum(counts)
        return made

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The position with ``k`` positions before it."""
        if not 0 <= k < len(self):
            raise IndexError("position outside the set")
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.keys[at]) * SPAN + _select(*self.containers[at], int(k - self.before[at]))

    def n_bytes(self) -> int:
        return sum(data.nbytes for _, data in self.containers)


def _container(low: np.ndarray) -> tuple[int, np.ndarray]:
    """The form that takes the fewest bytes, and its data; of forms of equal size the first."""
    breaks = np.flatnonzero(np.diff(low.astype(np.int32)) != 1)
    sizes = [2 * len(low), SPAN // 8, 4 * (len(breaks) + 1)]
    form = int(np.argmin(sizes))
    if form == ARRAY:
        return form, low
    if form == BITMAP:
        bits = np.zeros(SPAN, dtype=np.uint8)
        bits[low] = 1
        return form, np.packbits(bits, bitorder="little")
    starts = low[np.concatenate([[0], breaks + 1])]
    lengths = np.diff(np.concatenate([[-1], breaks, [len(low) - 1]]))
    # A run of all 65,536 values has a length of 65,535 more than one value, as lengths are stored less one.
    return form, np.stack([starts, (lengths - 1).astype(np.uint16)], axis=1)


def _select(form: int, data: np.ndarray, k: int) -> int:
    if form == ARRAY:
        return int(data[k])
    if form == BITMAP:
        ranks = np.cumsum(np.bitwise_count(data), dtype=np.int64)
        byte = int(np.searchsorted(ranks, k, side="right"))
        inside = k - (int(ranks[byte - 1]) if byte else 0)
        return byte * 8 + int(np.flatnonzero(np.unpackbits(data[byte : byte + 1], bitorder="little"))[inside])
    ends = np.cumsum(data[:, 1].astype(np.int64) + 1)
    run = int(np.searchsorted(ends, k, side="right"))
    return int(data[run, 0]) + k - (int(ends[run - 1]) if run else 0)
