"""Sparse vectors as compressed postings.

Features are numbered once, in their order. The entries of a key are cut into
blocks of ``SPAN`` feature numbers, so the layout never depends on the size of a
key and a block holds no more than ``SPAN`` entries. A block is one row: its
first number stands beside it as a skip entry, the numbers follow as gaps and the
counts as they are, both in bytes of seven bits with a continuation bit. One
entry of one key is found by opening a single block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import chunks, ranking

SPAN = 1 << 14
_BLOCK = pa.schema([("key", pa.string()), ("block", pa.int64()), ("first", pa.int64()), ("n", pa.int32()), ("data", pa.binary())])
_BLOCK_DDL = "key string, block bigint, first bigint, n int, data binary"


def packed(values: np.ndarray) -> bytes:
    """Non-negative integers in groups of seven bits, low group first; the high bit says that more follow."""
    values = np.asarray(values, dtype=np.uint64)
    bits = np.frexp(values.astype(np.float64))[1]
    # A float may round up to the next power of two, which costs a byte and no value.
    size = np.maximum(1, -(-bits // 7)).astype(np.int64)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    starts = ends - size
    for step in range(int(size.max()) if len(size) else 0):
        some = size > step
        group = ((values[some] >> np.uint64(7 * step)) & np.uint64(0x7F)).astype(np.uint8)
        out[starts[some] + step] = group | np.where(size[some] > step + 1, 0x80, 0).astype(np.uint8)
    return out.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    """Inverse of :func:`packed`."""
    data = np.frombuffer(raw, dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    last = np.flatnonzero(data < 0x80)
    starts = np.concatenate([[0], last[:-1] + 1]).astype(np.int64)
    place = np.arange(len(data)) - np.repeat(starts, last - starts + 1)
    parts = (data & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.add.reduceat(parts, starts)


def numbers(counts: DataFrame, feature: str) -> DataFrame:
    """``(feature, number)`` of all features, from 0 in their order."""
    ranked = ranking.global_rank(counts.select(feature).distinct(), [F.col(feature)])
    return ranked.select(feature, (F.col("rank") - 1).cast("bigint").alias("number"))


def encode(counts: DataFrame, numbered: DataFrame, key: str, feature: str, span: int = SPAN) -> DataFrame:
    """``(key, block, first, n, data)`` of a ``(key, feature, cnt)`` table with one row per key and feature."""
    entries = chunks.salted_lookup(counts.select(key, feature, "cnt"), numbered, feature, key, "inner").select(
        F.col(key).cast("string").alias("key"), F.expr(f"number div {span}").alias("block"), "number", F.col("cnt").cast("bigint").alias("cnt")
    )
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = entries.repartition(tasks, "key", "block").sortWithinPartitions("key", "block", "number")
    return dealt.mapInArrow(_encode, _BLOCK_DDL)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        keys, blocks = held["key"].to_pylist(), held["block"].to_numpy()
        # The last block may go on in the next batch.
        cut = len(keys)
        while cut and keys[cut - 1] == keys[-1] and blocks[cut - 1] == blocks[-1]:
            cut -= 1
        if cut:
            yield _blocks(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None:
        yield _blocks(held)


def _blocks(table: pa.Table) -> pa.RecordBatch:
    keys = table["key"].to_pylist()
    blocks, number, cnt = (table[c].to_numpy() for c in ("block", "number", "cnt"))
    fresh = np.array([True, *(a != b for a, b in zip(keys, keys[1:]))]) | np.concatenate([[True], blocks[1:] != blocks[:-1]])
    starts = np.flatnonzero(fresh)
    rows = []
    for start, stop in zip(starts, [*starts[1:], len(keys)], strict=True):
        gaps = np.diff(number[start:stop], prepend=number[start])
        rows.append((keys[start], int(blocks[start]), int(number[start]), int(stop - start), packed(gaps) + packed(cnt[start:stop])))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BLOCK, strict=True)], schema=_BLOCK)


def decode(postings: DataFrame, numbered: DataFrame, key: str, feature: str) -> DataFrame:
    """``(key, feature, cnt)`` of all rows of ``postings``; inverse of :func:`encode`."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = unpacked(data).astype(np.int64)
                found = [pa.array([name] * n, pa.string()), pa.array(first + np.cumsum(values[:n])), pa.array(values[n:])]
                yield pa.RecordBatch.from_arrays(found, names=["key", "number", "cnt"])

    entries = postings.select("key", "first", "n", "data").mapInArrow(opened, "key string, number bigint, cnt bigint")
    met = chunks.salted_lookup(entries, numbered, "number", "key", "inner")
    return met.select(F.col("key").alias(key), feature, "cnt")


def of_key(postings: DataFrame, numbered: DataFrame, name: str, key: str, feature: str) -> DataFrame:
    """:func:`decode` of one key: other keys' rows are left out by a filter that reaches the scan."""
    return decode(postings.filter(F.col("key") == name), numbered, key, feature)


def entry(postings: DataFrame, name: str, number: int, span: int = SPAN) -> int:
    """The count of one key at one feature number, 0 if there is none; opens at most one block."""
    place = (F.col("key") == name) & (F.col("block") == number // span) & (F.col("first") <= number)
    row = postings.filter(place).select("first", "n", "data").first()
    if row is None:
        return 0
    values = unpacked(bytes(row["data"])).astype(np.int64)
    found = np.flatnonzero(row["first"] + np.cumsum(values[: row["n"]]) == number)
    return int(values[row["n"] + found[0]]) if len(found) else 0
