"""Comparing rows that share a bucket, for buckets of any size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import stored, tasks

CHUNK = 1024
#: Pairs that one call of a comparison may hold.
CALL_PAIRS = 4_000_000


def met(slots: DataFrame, chunk: int = CHUNK, large: DataFrame | None = None) -> DataFrame:
    """``slot, item`` rows dealt so that any two items of a slot meet in some group, sorted by group.

    Slots above ``chunk`` rows are cut into chunks by a hash of the item, and
    chunks meet pairwise, each pair a group of its own. Only those slots are
    listed, so the list is shorter than the rows by that factor. ``large`` gives
    ``slot, chunks`` of the slots to cut where the number of rows does not decide.
    The list is stored, so that the join knows its size: rows are shuffled for it
    only if the list is too long to broadcast.
    """
    if large is None:
        large = slots.groupBy("slot").count().filter(F.col("count") > chunk).select(
            "slot", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")
        )
    large = stored(large, "large-slots")
    own = F.pmod(F.xxhash64("item"), F.col("chunks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(
        F.least(own, j).alias("i"), F.greatest(own, j).alias("j")
    ))
    single = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    dealt = slots.join(large, "slot", "left").select(
        "slot", "item", F.explode(F.when(F.col("chunks").isNull(), single).otherwise(others)).alias("at")
    ).select(F.xxhash64("slot", "at.i", "at.j").alias("slot"), "item")
    return dealt.repartition(tasks(slots.sparkSession), "slot").sortWithinPartitions("slot")


def runs(batches: Iterator[pa.RecordBatch], width: int, found: Callable[[np.ndarray, np.ndarray], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Calls ``found(run numbers, items as rows of bytes)`` for whole groups of two items or more.

    A group may go on in the next batch, so the last one is held back.
    """

    def calls(slot: np.ndarray, raw: np.ndarray) -> Iterator[pa.RecordBatch]:
        number = np.cumsum(np.concatenate([[0], slot[1:] != slot[:-1]]))
        sizes = np.bincount(number)
        alone = sizes[number] == 1
        number, raw = number[~alone], raw[~alone]
        # Whole groups only, as many at a time as the pairs allow.
        pairs = np.where(sizes > 1, sizes.astype(np.int64) ** 2 // 2, 0)
        call = (np.cumsum(pairs) // CALL_PAIRS)[number]
        for one in np.unique(call):
            mine = call == one
            yield found(number[mine], raw[mine])

    held_slot, held = np.zeros(0, dtype=np.int64), np.zeros((0, width), dtype=np.uint8)
    for batch in batches:
        if not batch.num_rows:
            continue
        slot = np.concatenate([held_slot, batch.column(0).to_numpy(zero_copy_only=False)])
        raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, width)
        held = np.concatenate([held, raw])
        cut = int(np.flatnonzero(slot != slot[-1])[-1]) + 1 if slot[0] != slot[-1] else 0
        if cut:
            yield from calls(slot[:cut], held[:cut])
        held_slot, held = slot[cut:], held[cut:]
    if len(held):
        yield from calls(held_slot, held)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """Sorted items of every group of two items or more; items may differ in width."""
    slot, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        slots, items = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
        cuts = (np.flatnonzero(slots[1:] != slots[:-1]) + 1).tolist()
        for start, stop in zip([0, *cuts], [*cuts, len(items)], strict=True):
            if slots[start] != slot:
                if len(held) > 1:
                    yield sorted(held)
                slot, held = slots[start], []
            held += items[start:stop]
    if len(held) > 1:
        yield sorted(held)


def spanning_edges(n: int, a: np.ndarray, b: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Positions of the edges of a minimum spanning forest of ``n`` nodes: every tree takes its cheapest edge, trees merge, again."""
    order = np.argsort(cost, kind="stable")
    a, b = a[order], b[order]
    # From here on an edge's position is its rank, so costs are all different and no circle can close.
    rank = np.arange(len(a))
    tree = np.arange(n)
    kept = [np.zeros(0, dtype=np.int64)]
    while True:
        x, y = tree[a[rank]], tree[b[rank]]
        between = x != y
        rank, x, y = rank[between], x[between], y[between]
        if not len(rank):
            return order[np.concatenate(kept)]
        best = np.full(n, len(order))
        np.minimum.at(best, x, rank)
        np.minimum.at(best, y, rank)
        chosen = np.unique(best[best < len(order)])
        kept.append(chosen)
        tree = merged(n, tree[a[chosen]], tree[b[chosen]])[tree]


def merged(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest index that each of ``n`` nodes reaches over the edges."""
    low = np.arange(n)
    while True:
        # Roots are joined, never single nodes, so whatever points at a root moves with it.
        x, y = low[a], low[b]
        open_ = x != y
        if not open_.any():
            return low
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(deeper := low[low], low):
            low = deeper
