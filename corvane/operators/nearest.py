"""Nearest-centre assignment of a large point table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import vectors
from corvane.operators.centre_tree import CentreTree

# A centre table above this is sent in slices, one pass over the points each.
SLICE_BYTES = 64 << 20
# A smaller one travels with the function itself.
INLINE_BYTES = 1 << 18
# Cells of one distance matrix: small enough to stay in a core's cache.
BLOCK_CELLS = 1 << 17
MIN_BLOCK_ROWS = 64
# From so many centres on a tree over them is searched.
TREE_CENTRES = 512


def batch_matrix(column: pa.Array) -> np.ndarray:
    """List column of equal lengths -> (rows, d) float64; nulls and other lengths raise."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("a vector is null")
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and lengths.min() != lengths.max():
        raise ValueError(f"vectors of {lengths.min()} and {lengths.max()} coordinates in one table")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def exact_sq_distance(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Row by row, added up in coordinate order as a plain loop would."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        step = x[:, j] - m[:, j]
        total += step * step
    return total


def searched(centres: np.ndarray) -> np.ndarray | CentreTree:
    """What tasks search: a tree over many centres, few as they are."""
    return CentreTree(centres) if len(centres) >= TREE_CENTRES else centres


def nearest(x: np.ndarray, centres: np.ndarray | CentreTree, measure: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """``(index, squared distance)`` per row; the lowest index wins a tie."""
    if isinstance(centres, CentreTree):
        tree, centres = centres, centres.centres
        index = nearest_margin(x, centres)[0] if tree.plain else tree.search(x)[0]
    else:
        index, _ = nearest_margin(x, centres)
    return index, exact_sq_distance(x, centres[index]) if measure else None


def nearest_margin(x: np.ndarray, centres: np.ndarray | CentreTree) -> tuple[np.ndarray, np.ndarray]:
    """``(index, margin)`` per row: how much farther the second centre is than the nearest, 0 if in doubt.

    A matrix product ranks the centres up to rounding. Only rows whose second
    best centre is that close are measured exactly against all such centres.
    """
    if isinstance(centres, CentreTree):
        if not centres.plain:
            return centres.search(x, margin=True)
        centres = centres.centres
    if x.shape[1] != centres.shape[1]:
        raise ValueError(f"points have {x.shape[1]} coordinates, centres {centres.shape[1]}")
    index = np.zeros(len(x), dtype=np.int32)
    margin = np.zeros(len(x))
    norms = (centres * centres).sum(axis=1)
    twice = np.ascontiguousarray(-2.0 * centres.T)
    block = max(MIN_BLOCK_ROWS, BLOCK_CELLS // len(centres))
    slack = 16 * (x.shape[1] + 4) * np.finfo(np.float64).eps
    for at in range(0, len(x), block):
        part = x[at : at + block]
        # |x|^2 is the same for all centres and left out.
        rough = part @ twice
        rough += norms
        best = rough.argmin(axis=1)
        rows = np.arange(len(part))
        low = rough[rows, best]
        own = np.einsum("ij,ij->i", part, part)
        limit = low + slack * (own + norms.max())
        rough[rows, best] = np.inf
        second = rough.min(axis=1)
        close = np.flatnonzero(second <= limit)
        error = slack * (own + norms.max())
        far = np.sqrt(np.maximum(second + own - error, 0)) if len(centres) > 1 else np.full(len(part), np.inf)
        margin[at : at + block] = far - np.sqrt(np.maximum(low + own + error, 0))
        if len(close):
            rough[close, best[close]] = low[close]
            row, cid = np.nonzero(rough[close] <= limit[close, None])
            exact = exact_sq_distance(part[close[row]], centres[cid])
            order = np.lexsort((cid, exact, row))
            first = np.unique(row[order], return_index=True)[1]
            best[close] = cid[order[first]]
            margin[at + close] = 0
        index[at : at + block] = best
    return index, margin


@dataclass
class Inline:
    value: object


def sent_to_tasks(spark: SparkSession, value: object, size: int):
    """Something with ``value``: inside the task function, or a broadcast when larger."""
    return Inline(value) if size <= INLINE_BYTES else spark.sparkContext.broadcast(value)


def centre_slices(centres: np.ndarray, slice_bytes: int = SLICE_BYTES) -> list[tuple[int, np.ndarray]]:
    rows = max(1, slice_bytes // max(1, centres.shape[1] * 8))
    return [(at, centres[at : at + rows]) for at in range(0, len(centres), rows)]


def assign_clusters(
    points: DataFrame, centres: np.ndarray, vector: str = "x", name: str = "cid",
    keep_vector: bool = False, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Adds ``cid`` and ``d2`` of the nearest centre. No shuffle, no k-fold row growth.

    Vectors may be float or double arrays; distances are double. The vector goes
    to the Python worker once and comes back only with ``keep_vector``.

    Centres are k x d numbers set by the caller, not by the data. They are
    broadcast up to ``slice_bytes``; a larger table goes out slice by slice,
    each pass keeping the better of its own and the earlier best.
    """
    dist = f"{name}_d2" if name != "cid" else "d2"
    found = [T.StructField(name, T.IntegerType()), T.StructField(dist, T.DoubleType())]
    slices = centre_slices(np.ascontiguousarray(centres, dtype=np.float64), slice_bytes)
    out = points
    for first, part in slices:
        needed = keep_vector or first != slices[-1][0]
        carried = [c for c in points.columns if needed or c != vector]
        schema = T.StructType([points.schema[c] for c in carried] + found)
        sent = sent_to_tasks(points.sparkSession, searched(part), part.nbytes)
        out = out.mapInArrow(_better_of(sent, first, vector, name, dist, carried), schema)
    return out


def _better_of(sent, first: int, vector: str, name: str, dist: str, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = dict(zip(batch.schema.names, batch.columns))
            cid, d2 = nearest(batch_matrix(column[vector]), sent.value)
            cid = cid + np.int32(first)
            if first:
                # Earlier slices have the lower indices, so they keep a tie.
                best = column[name].to_numpy(zero_copy_only=False)
                best_d2 = column[dist].to_numpy(zero_copy_only=False)
                better = d2 < best_d2
                cid, d2 = np.where(better, cid, best), np.where(better, d2, best_d2)
            columns = [column[c] for c in carried]
            columns += [pa.array(cid, pa.int32()), pa.array(d2, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, name, dist])

    return run


def assign_by_expression(points: DataFrame, centres: np.ndarray, vector: str = "x") -> DataFrame:
    """The same as one column expression inside the JVM, for small k x d."""
    table = vectors.vector_table_literal(centres)
    out = points.withColumn("best", vectors.nearest_center(vectors.doubles(F.col(vector)), table))
    return out.select(*points.columns, F.col("best.cid").alias("cid"), F.col("best.d2").alias("d2"))
