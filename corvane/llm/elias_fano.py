"""Elias-Fano code of a non-decreasing sequence of non-negative integers.

The low ``l = floor(log2(u / n))`` bits of each value are packed; the high
parts are written in unary. A sequence takes about ``n * (2 + l)`` bits.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = "<QQB"


def encode(values: np.ndarray) -> bytes:
    """Code of ``values``; an empty sequence gives a header only."""
    v = np.asarray(values, dtype=np.uint64)
    n = len(v)
    if n == 0:
        return struct.pack(_HEAD, 0, 0, 0)
    if np.any(v[1:] < v[:-1]):
        raise ValueError("values must not decrease")
    top = int(v[-1])
    low_bits = max(0, (top // n).bit_length() - 1) if top >= n else 0
    ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
    high[ones] = 1
    shifts = np.arange(low_bits, dtype=np.uint64)
    low = ((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return (
        struct.pack(_HEAD, n, top, low_bits)
        + np.packbits(low.ravel(), bitorder="little").tobytes()
        + np.packbits(high, bitorder="little").tobytes()
    )


class EliasFano:
    """Random access to a code. ``select`` finds ones by a running count per 64-bit word."""

    def __init__(self, code: bytes):
        self.n, self.top, self.low_bits = struct.unpack_from(_HEAD, code)
        at = struct.calcsize(_HEAD)
        low_bytes = (self.n * self.low_bits + 7) // 8
        self.low = np.frombuffer(code, np.uint8, low_bytes, at)
        raw = code[at + low_bytes :]
        self.high = np.frombuffer(raw + b"\0" * (-len(raw) % 8), "<u8")
        self.before = np.cumsum(np.bitwise_count(self.high), dtype=np.uint32)

    def __len__(self) -> int:
        return self.n

    def select(self, k) -> np.ndarray:
        """Values at the positions ``k`` (0-based)."""
        k = np.atleast_1d(np.asarray(k, dtype=np.int64))
        if len(k) and (k.min() < 0 or k.max() >= self.n):
            raise IndexError("position outside the sequence")
        if not len(k):
            return np.zeros(0, dtype=np.int64)
        word = np.searchsorted(self.before, k, side="right")
        inside = k - np.where(word > 0, self.before[word - 1], 0).astype(np.int64)
        bits = np.unpackbits(self.high[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ranks = np.cumsum(bits, axis=1, dtype=np.int16)
        place = np.argmax(ranks == (inside + 1)[:, None], axis=1) + word * 64
        return ((place - k) << self.low_bits) | self._lows(k)

    def _lows(self, k: np.ndarray) -> np.ndarray:
        out = np.zeros(len(k), dtype=np.int64)
        for bit in range(self.low_bits):
            at = k * self.low_bits + bit
            out |= ((self.low[at >> 3] >> (at & 7)) & 1).astype(np.int64) << bit
        return out

    def values(self) -> np.ndarray:
        return self.select(np.arange(self.n))
