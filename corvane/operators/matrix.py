"""Matrix products on coordinate tables ``(i, j, v)``; an absent cell is 0."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import chunks

BLOCK = 64
# Block rows (columns) of one output region handled by one task.
GROUP = 16
# Output blocks a task adds up before it hands them on: two regions.
HELD_BLOCKS = 512
BLOCK_SCHEMA = "bi bigint, bj bigint, cells binary"


def cells(points: DataFrame, row: str = "id", vector: str = "x") -> DataFrame:
    """A vector table as coordinates: one row per vector and position."""
    return points.select(F.col(row).alias("i"), F.posexplode(vector).alias("j", "v")).select(
        "i", F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("v")
    )


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def matmul_coo(a: DataFrame, b: DataFrame, chunk_rows: int = chunks.CHUNK_ROWS) -> DataFrame:
    """Sparse product: join on the inner index, add up by (i, j).

    An inner index with many cells on both sides is cut into chunk pairs.
    """
    left = a.select(F.col("j").alias("k"), "i", F.col("v").alias("av"))
    right = b.select(F.col("i").alias("k"), "j", F.col("v").alias("bv"))
    met = chunks.chunked_join(left, right, "k", ("i", "j"), ("av", "bv"), chunk_rows)
    return met.groupBy("i", "j").agg(F.sum(F.col("av") * F.col("bv")).alias("v"))


def matmul_block(a: DataFrame, b: DataFrame, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """Dense product by blocks. Indices are bigint from 0; cells that no product reaches are left out, as in ``matmul_coo``.

    Blocks of A and B meet by inner block and by output region (a square of
    ``group`` x ``group`` output blocks), so a short inner dimension still uses
    many tasks. The regions a block goes to follow from the largest index of the
    other side. A task meets its regions one after another and adds up their
    products per output block; blocks stay whole through the shuffle that adds
    up the sums of all tasks, at most one for each task, and become cells last.
    """
    left, right = _blocks(a, block), _blocks(b, block)
    last_gi = a.agg(F.expr(f"max(i) div {block * group}")).scalar()
    last_gj = b.agg(F.expr(f"max(j) div {block * group}")).scalar()
    zero = F.lit(0).cast("bigint")
    left = left.select(
        F.expr(f"bi div {group}").alias("gi"), F.explode(F.sequence(zero, F.coalesce(last_gj, zero))).alias("gj"),
        F.col("bj").alias("bk"), "bi", F.col("cells").alias("left"),
    )
    right = right.select(
        F.explode(F.sequence(zero, F.coalesce(last_gi, zero))).alias("gi"), F.expr(f"bj div {group}").alias("gj"),
        F.col("bi").alias("bk"), "bj", F.col("cells").alias("right"),
    )
    on = ["gi", "gj", "bk"]
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = left.repartition(tasks, *on).join(right.repartition(tasks, *on), on).select("bi", "bj", "left", "right")
    sums = met.mapInArrow(_block_products(block), BLOCK_SCHEMA)
    dealt = sums.repartition(tasks, "bi", "bj").sortWithinPartitions("bi", "bj")
    return dealt.mapInArrow(_cells_of_sums(block), "i bigint, j bigint, v double")


def _blocks(m: DataFrame, block: int) -> DataFrame:
    """``(bi, bj, cells)``: row-major dense blocks, then a byte per cell that says whether it is there; repeated cells are added up."""
    tasks = int(m.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = m.select(
        F.expr(f"i div {block}").alias("bi"),
        F.expr(f"j div {block}").alias("bj"),
        ((F.col("i") % block) * block + F.col("j") % block).cast("int").alias("at"),
        F.col("v").cast("double").alias("v"),
    ).filter(F.col("v").isNotNull())
    dealt = cell.repartition(tasks, "bi", "bj").sortWithinPartitions("bi", "bj")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums, there = None, None, None
        for batch in batches:
            bi, bj, at, v = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for start, stop in _runs(bi, bj):
                if key != (bi[start], bj[start]):
                    if key is not None:
                        yield _block_batch({key: [sums, there]})
                    key, sums, there = (bi[start], bj[start]), np.zeros(block * block), np.zeros(block * block, dtype=bool)
                np.add.at(sums, at[start:stop], v[start:stop])
                there[at[start:stop]] = True
        if key is not None:
            yield _block_batch({key: [sums, there]})

    return dealt.mapInArrow(fill, BLOCK_SCHEMA)


def _runs(bi: np.ndarray, bj: np.ndarray) -> list[tuple[int, int]]:
    """Where one pair of values begins and ends."""
    if not len(bi):
        return []
    cuts = (np.flatnonzero((bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(bi)], strict=True))


def _opened(raw: bytes, block: int) -> tuple[np.ndarray, np.ndarray]:
    size = block * block
    return np.frombuffer(raw, count=size).reshape(block, block), np.frombuffer(raw, np.uint8, size, 8 * size).reshape(block, block)


def _block_products(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for bi, bj, left, right in zip(*columns, strict=True):
                (x, in_x), (y, in_y) = _opened(left, block), _opened(right, block)
                reached = in_x.astype(np.float32) @ in_y.astype(np.float32) > 0
                if (bi, bj) in held:
                    held[bi, bj][0] += x @ y
                    held[bi, bj][1] |= reached
                else:
                    held[bi, bj] = [x @ y, reached]
                if len(held) >= HELD_BLOCKS:
                    yield _block_batch(held)
                    held = {}
        if held:
            yield _block_batch(held)

    return run


def _block_batch(held: dict[tuple[int, int], list[np.ndarray]]) -> pa.RecordBatch:
    cells = [m.tobytes() + there.astype(np.uint8).tobytes() for m, there in held.values()]
    bi, bj = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(bi, pa.int64()), pa.array(bj, pa.int64()), pa.array(cells, pa.binary())], names=["bi", "bj", "cells"])


def _cells_of_sums(block: int):
    """Adds up the blocks of one place, which follow each other, and takes them apart."""

    def cells_of(key: tuple[int, int], sums: np.ndarray, there: np.ndarray) -> pa.RecordBatch:
        row, column = np.nonzero(there)
        values = [row + key[0] * block, column + key[1] * block, sums[row, column]]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["i", "j", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums, there = None, None, None
        for batch in batches:
            for bi, bj, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                m, reached = _opened(raw, block)
                if key == (bi, bj):
                    sums, there = sums + m, there | reached
                    continue
                if key is not None:
                    yield cells_of(key, sums, there)
                key, sums, there = (bi, bj), m, reached
        if key is not None:
            yield cells_of(key, sums, there)

    return run


def matmul(a: DataFrame, b: DataFrame, method: str = "coo") -> DataFrame:
    """``A . B`` by ``coo`` or ``block``: the same cells, those with at least one product. Blocks suit dense inputs."""
    if method not in ("coo", "block"):
        raise ValueError(f"unknown method {method!r}")
    return matmul_block(a, b) if method == "block" else matmul_coo(a, b)


def gram_products(x: DataFrame, repeated: bool = True, chunk_rows: int = chunks.CHUNK_ROWS) -> DataFrame:
    """``(i, j, product)`` with ``i <= j`` for every two cells of X below one inner index, each pair once.

    Cells that stand in X more than once are added up first; ``repeated=False`` says that none do.

    Cells of an inner index are cut into chunks and only chunk pairs ``lo <= hi``
    meet: X is shuffled by inner index once and meets itself, not its transpose.
    """
    there = x.filter(F.col("v").isNotNull())
    unique = there.groupBy("i", "j").agg(F.sum("v").alias("v")) if repeated else there
    # Never null, and said so for the same reason as in ``chunks``.
    marked = chunks.mark_by_key(unique.select(F.col("j").alias("k"), "i", F.coalesce("v", F.lit(0)).alias("v")), "k", "i", "v", chunk_rows)
    pairs = chunks.unordered_pairs(marked, ["k"], "i", "v").select(
        F.col("a").alias("i"), F.col("b").alias("j"), (F.col("va") * F.col("vb")).alias("product")
    )
    own = marked.select("i", F.col("i").alias("j"), (F.col("v") * F.col("v")).alias("product"))
    return pairs.unionByName(own)


def gram_matrix(x: DataFrame, repeated: bool = True, chunk_rows: int = chunks.CHUNK_ROWS) -> DataFrame:
    """All dot products between the rows of a sparse X, those of rows without a common column left out.

    Every product is made once and its sum written to both sides of the diagonal.
    """
    upper = gram_products(x, repeated, chunk_rows).groupBy("i", "j").agg(F.sum("product").alias("v"))
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    )
    return upper.select(F.explode(both).alias("at"), "v").select("at.i", "at.j", "v")
