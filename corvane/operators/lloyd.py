"""Lloyd k-means with a membership-change stop rule."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.nearest import (
    SLICE_BYTES, assign_clusters, batch_matrix, centre_slices, nearest, nearest_margin, searched, sent_to_tasks,
)
from corvane.operators.step_log import Step, StepLog

# Partial sums of all tasks that may go to the driver without a shuffle.
DIRECT_BYTES = 16 << 20
PARTIAL_SCHEMA = "cid int, n bigint, changed bigint, sums array<double>"


@dataclass
class Clustering:
    """``centres (cid, m)``, ``membership (id, cid)``, ``trace (step, changed, delta)``."""

    centres: DataFrame
    membership: DataFrame
    trace: DataFrame
    centre_array: np.ndarray
    steps: int


def as_points(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``(id, x)``, the vector as stored; rows without a vector are no points."""
    return df.select(F.col(id_column).alias("id"), F.col(vector).alias("x")).filter(F.col("x").isNotNull())


def seed_rows(points: DataFrame, k: int) -> DataFrame:
    """The first ``k`` points by id, as ``(cid, id, m)``."""
    first = points.orderBy("id").limit(k)
    # k rows: numbering them is a window over the seeds alone.
    ranked = first.agg(F.array_sort(F.collect_list(F.struct("id", "x"))).alias("rows"))
    return ranked.select(F.posexplode("rows").alias("cid", "row")).select(
        "cid", F.col("row.id").alias("id"), F.col("row.x").cast("array<double>").alias("m")
    )


def seed_centers(points: DataFrame, k: int) -> np.ndarray:
    """The first ``k`` points by id as a k x d array."""
    if k < 2:
        raise ValueError("k must be greater than 1")
    rows = points.orderBy("id").limit(k).select("id", "x").collect()
    if len(rows) < k:
        raise ValueError(f"k = {k} exceeds the number of points ({len(rows)})")
    rows.sort(key=lambda r: r["id"])
    return np.array([r["x"] for r in rows], dtype=np.float64)


def centre_rows(spark: SparkSession, centres: np.ndarray) -> DataFrame:
    """A k x d array as ``(cid, m)``."""
    table = pa.table({
        "cid": pa.array(range(len(centres)), pa.int32()),
        "m": pa.array(centres.tolist(), pa.list_(pa.float64())),
    })
    return spark.createDataFrame(table)


def partial_totals(points: DataFrame, centres: np.ndarray, previous: np.ndarray | None,
                   slice_bytes: int) -> DataFrame | None:
    """``(cid, n, changed, sums)`` per task, or None when the centres need several slices."""
    arrays = [np.ascontiguousarray(c, dtype=np.float64) for c in (centres, previous) if c is not None]
    if any(len(centre_slices(c, slice_bytes)) > 1 for c in arrays):
        return None
    sent = sent_to_tasks(points.sparkSession, [searched(arrays[0]), *arrays[1:]], sum(c.nbytes for c in arrays))
    return points.select("x").mapInArrow(_partial_sums(sent), PARTIAL_SCHEMA)


def cluster_arrays(points: DataFrame, centres: np.ndarray, previous: np.ndarray | None = None,
                   slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(cid, n, changed, sums)``: size, moved points and the sum vector, one row per cluster and task after the shuffle.

    ``changed`` counts points whose centre among ``previous`` was another one;
    without ``previous`` all points count. No per-point state outlives a step,
    so a lost executor costs only its own partitions. Vectors stay whole: rows
    are added up before and after a shuffle by cluster, never taken apart.
    """
    partials = partial_totals(points, centres, previous, slice_bytes)
    if partials is None:
        assigned = assign_clusters(points.select("x"), centres, keep_vector=True, slice_bytes=slice_bytes)
        if previous is not None:
            assigned = assign_clusters(assigned, previous, name="old", keep_vector=True, slice_bytes=slice_bytes)
        old = "old" if previous is not None else F.lit(-1).alias("old")
        partials = assigned.select("cid", old, "x").mapInArrow(_assigned_sums, PARTIAL_SCHEMA)
    return partials.repartition("cid").mapInArrow(_added_rows, PARTIAL_SCHEMA)


def cluster_totals(points: DataFrame, centres: np.ndarray, previous: np.ndarray | None = None,
                   slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(cid, pos, n, changed, total)``: the sums of ``cluster_arrays`` by coordinate."""
    rows = cluster_arrays(points, centres, previous, slice_bytes).select(
        "cid", "n", "changed", F.posexplode("sums").alias("pos", "v")
    )
    return rows.groupBy("cid", "pos").agg(
        F.sum("n").alias("n"), F.sum("changed").alias("changed"), F.sum("v").alias("total")
    )


def total_arrays(points: DataFrame, centres: np.ndarray, previous: np.ndarray | None = None,
                 slice_bytes: int = SLICE_BYTES, parts: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, moved points and sums of all clusters as arrays.

    Few tasks hand their k x d partial sums straight to the driver; when those
    could exceed ``DIRECT_BYTES`` they are added up by a shuffle first.
    ``parts`` is the number of tasks, where the caller knows it.
    """
    n, changed, sums = np.zeros(len(centres), int), np.zeros(len(centres), int), np.zeros(centres.shape)
    if parts is None:
        parts = points.rdd.getNumPartitions()
    direct = parts * centres.nbytes <= DIRECT_BYTES
    partials = partial_totals(points, centres, previous, slice_bytes) if direct else None
    if partials is None:
        partials = cluster_arrays(points, centres, previous, slice_bytes)
    table = partials.toArrow().combine_chunks()
    cid = table["cid"].to_numpy()
    np.add.at(n, cid, table["n"].to_numpy())
    np.add.at(changed, cid, table["changed"].to_numpy())
    if len(cid):
        flat = table["sums"].combine_chunks().flatten().to_numpy()
        np.add.at(sums, cid, flat.reshape(-1, centres.shape[1]))
    return n, changed, sums


def _grouped_sums(cid: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(cid, kind="stable")
    present, starts = np.unique(cid[order], return_index=True)
    return present, np.add.reduceat(rows[order], starts, axis=0)


def _sums_batch(cid, n, changed, sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cid, pa.int32()), pa.array(n, pa.int64()), pa.array(changed, pa.int64()), pa.array(list(sums), pa.list_(pa.float64()))],
        names=["cid", "n", "changed", "sums"],
    )


class _Held:
    """Sums of the clusters a task has met; clusters it never met take no room."""

    def __init__(self):
        self.rows: dict[int, list] = {}

    def add(self, cid: np.ndarray, n: np.ndarray, changed: np.ndarray, sums: np.ndarray) -> None:
        for c, count, moved, vector in zip(cid.tolist(), n.tolist(), changed.tolist(), sums, strict=True):
            row = self.rows.get(c)
            if row is None:
                self.rows[c] = [count, moved, vector.copy()]
            else:
                row[0] += count
                row[1] += moved
                row[2] += vector

    def batch(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            n, changed, sums = zip(*self.rows.values(), strict=True)
            yield _sums_batch(list(self.rows), n, changed, sums)


def _added_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Held()
    for batch in batches:
        if batch.num_rows:
            held.add(*(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)), batch_matrix(batch.column(3)))
    yield from held.batch()


def _assigned_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Held()
    for batch in batches:
        if batch.num_rows:
            cid, old = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            present, sums = _grouped_sums(cid, batch_matrix(batch.column(2)))
            held.add(present, np.bincount(cid)[present], np.bincount(cid[cid != old], minlength=cid.max() + 1)[present], sums)
    yield from held.batch()


def _partial_sums(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, *previous = sent.value
        centres = getattr(search, "centres", search)
        n = np.zeros(len(centres), dtype=np.int64)
        changed = np.zeros(len(centres), dtype=np.int64)
        sums = np.zeros(centres.shape)
        # No centre moved further than this, so a point whose second centre is
        # farther than its own by twice as much had the same centre before.
        reach = 2 * np.sqrt(((centres - previous[0]) ** 2).sum(axis=1).max()) if previous else 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch_matrix(batch.column(0))
            cid, margin = nearest_margin(x, search)
            if previous:
                open_ = np.flatnonzero(margin <= reach * (1 + 1e-9) + 1e-9)
                was = nearest(x[open_], previous[0], measure=False)[0] if len(open_) else cid[:0]
                moved = cid[open_][was != cid[open_]]
            else:
                moved = cid
            n += np.bincount(cid, minlength=len(n))
            changed += np.bincount(moved, minlength=len(n))
            present, added = _grouped_sums(cid, x)
            sums[present] += added
        used = np.flatnonzero(n)
        yield _sums_batch(used, n[used], changed[used], sums[used])

    return run


def step_rows(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """One Lloyd step as ``(cid, pos, value)``; an empty cluster keeps its centre."""
    old = centre_rows(points.sparkSession, centres).select(
        "cid", F.posexplode("m").alias("pos", "old")
    )
    # k x d rows on both sides.
    totals = cluster_totals(points, centres)
    return old.join(totals, ["cid", "pos"], "left").select(
        "cid", "pos", F.coalesce(F.col("total") / F.col("n"), F.col("old")).alias("value")
    )


def step_arrays(points: DataFrame, centres: np.ndarray, previous: np.ndarray | None,
                slice_bytes: int = SLICE_BYTES, parts: int | None = None) -> tuple[np.ndarray, int, int]:
    """One step on the driver's k x d numbers: (new centres, changed, points)."""
    n, changed, sums = total_arrays(points, centres, previous, slice_bytes, parts)
    new = np.array(centres, dtype=np.float64)
    new[n > 0] = sums[n > 0] / n[n > 0, None]
    return new, int(changed.sum()), int(n.sum())


def lloyd(points: DataFrame, k: int, threshold: float = 0.001, max_steps: int = 501,
          seeds: np.ndarray | None = None, slice_bytes: int = SLICE_BYTES,
          cache: bool = True, log: str | None = None) -> Clustering:
    """Repeats steps until at most ``threshold`` of the points changed cluster.

    Centres and one count per step come to the driver; points stay cached where
    they are, or are scanned again each step with ``cache=False``. The membership returned is the one the last means were taken over.

    With ``log``, a folder that driver and executors share, every step is
    committed there, and a run that finds steps of an earlier one goes on after
    the last: trace, centres and membership are those of a single run. A log of
    other seeds, another k or another number of points raises.
    """
    spark = points.sparkSession
    kept = StepLog(spark, log) if log else None
    done, last = kept.read() if kept else ([], [])
    centres = np.array(seeds, dtype=np.float64) if seeds is not None else last[0].centres if last else seed_centers(points, k)
    if len(centres) < 2:
        raise ValueError("k must be greater than 1")
    table = points.select("id", "x")
    if cache:
        table = table.persist()
    used, previous, trace = centres, None, [(step, changed, changed / n) for step, changed, n in done]
    if kept and not last:
        kept.write(Step(0, 0, 0, centres))
    elif last:
        if len(centres) != k or not np.array_equal(last[0].centres, centres):
            raise ValueError(f"the log at {log} is of another run")
        centres = last[-1].centres
        if done:
            used = previous = last[-2].centres
    finished = bool(trace) and (trace[-1][2] <= threshold or len(trace) >= max_steps)
    # Asked once: under adaptive execution the question itself runs the shuffles below.
    parts = table.rdd.getNumPartitions()
    try:
        for step in range(len(trace) + 1, max_steps + 1) if not finished else ():
            used = centres
            centres, changed, n = step_arrays(table, used, previous, slice_bytes, parts)
            if done and n != done[-1][2]:
                raise ValueError(f"the log at {log} is of {done[-1][2]} points, not {n}")
            if kept:
                kept.write(Step(step, changed, n, centres))
            previous = used
            delta = changed / n
            trace.append((step, changed, delta))
            if delta <= threshold:
                break
    finally:
        if cache:
            table.unpersist()
    membership = assign_clusters(points.select("id", "x"), used, slice_bytes=slice_bytes)
    return Clustering(
        centres=centre_rows(spark, centres),
        membership=membership.select("id", "cid"),
        trace=spark.createDataFrame(trace, "step int, changed bigint, delta double"),
        centre_array=centres,
        steps=len(trace),
    )


def membership_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(changed, delta)`` of two memberships, joined by point id."""
    met = old.select("id", F.col("cid").alias("was")).join(new.select("id", "cid"), "id")
    moved = (F.col("was") != F.col("cid")).cast("bigint")
    return met.agg(F.sum(moved).alias("changed"), F.avg(moved).alias("delta"))
