"""Packing whole documents into sequences by best-two-fit.

A bin is filled greedily, the longest item that fits first. If a gap remains,
the shortest item of the bin is put back when two unpacked items fit the gap it
leaves more tightly, and the pair with the largest sum takes its place.

Items of one length are alike, so the bins are found on the histogram of
lengths, at most ``size`` classes whatever the corpus. A bin that the same
choices would build again, as long as all lengths in it last, is one pattern
with a number of uses; a pattern ends when one of its lengths runs out. Items
are ranked inside their length on Spark, and the rank alone says which use of
which pattern an item belongs to. The histogram is all that the driver sees.

Only documents longer than ``size`` are cut, into pieces of ``size`` ids; the
last piece may be shorter. Null and empty texts are documents of the end id
alone. Rows are packed as they are: repeated or null ids and equal texts are
items of their own. An empty table gives none. A very long text costs its ids
once in the task that encodes it. Columns other than ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corvane.llm import packing
from corvane.llm.common import stored

SIZE = 2048


def one_bin(left: np.ndarray, size: int) -> dict[int, int]:
    """Lengths of the next bin and how many of each; ``left`` counts the unpacked items by length."""
    left = left.copy()
    taken: dict[int, int] = {}
    gap = size
    while gap:
        fits = np.flatnonzero(left[: gap + 1])
        if not len(fits):
            break
        length = int(fits[-1])
        n = min(int(left[length]), gap // length)
        taken[length] = n
        left[length] -= n
        gap -= n * length
    shortest = min(taken)
    if gap and sum(taken.values()) > 1:
        pair = best_pair(left, gap + shortest)
        if sum(pair) > shortest:
            for length, n in ((shortest, -1), (pair[0], 1), (pair[1], 1)):
                taken[length] = taken.get(length, 0) + n
    return {length: n for length, n in taken.items() if n}


def best_pair(left: np.ndarray, room: int) -> tuple[int, ...]:
    """The two unpacked lengths with the largest sum within ``room``, the longer first; empty if there are none.

    Of equal sums the one with the longest item counts.
    """
    lengths = np.flatnonzero(left[: room + 1])
    if not len(lengths):
        return ()
    # The longest partner within what a length leaves, and not the length itself unless there are two of it.
    at = np.searchsorted(lengths, np.minimum(room - lengths, lengths), side="right") - 1
    alone = (at >= 0) & (lengths[at] == lengths) & (left[lengths] < 2)
    at = at - alone
    sums = np.where(at >= 0, lengths + lengths[at], 0)
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return (int(lengths[best]), int(lengths[at[best]])) if at[best] >= 0 else ()


def patterns(histogram: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Bins as ``(lengths and how many of each, uses)`` that together take every item."""
    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    found = []
    while left.any():
        taken = one_bin(left, size)
        uses = min(int(left[length]) // n for length, n in taken.items())
        for length, n in taken.items():
            left[length] -= n * uses
        found.append((taken, uses))
    return found


class Bins(packing.Plan):
    """Where the item with a length and a rank goes; all items are placed."""

    def __init__(self, histogram: dict[int, int], size: int = SIZE):
        parts: dict[int, list[tuple[int, int, int]]] = {length: [] for length in histogram}
        self.sequences = 0
        for taken, uses in patterns(histogram, size):
            for length, n in taken.items():
                parts[length].append((n * uses, self.sequences, uses))
            self.sequences += uses
        self.spans = {}
        for length, rows in parts.items():
            items, base, uses = np.array(rows, dtype=np.int64).reshape(-1, 3).T
            self.spans[length] = np.cumsum(items), base, uses


def pack(docs: DataFrame, tokenizer: str, end_id: int, spaces: str = "drop", size: int = SIZE) -> DataFrame:
    """``doc_id, piece, start, length, doc_tokens, sequence_id, offset, width, ids`` of every piece.

    ``ids`` are little-endian unsigned integers of ``width`` bytes. Offsets in
    a sequence have no gaps; the longest piece comes first.
    """
    store = stored(packing.chunks(docs, tokenizer, end_id, spaces, size), "two-fit-chunks")
    items = store.select("row", "chunk", F.col("length").alias("kind"))
    bins = Bins({r["kind"]: r["count"] for r in items.groupBy("kind").count().collect()}, size)

    @pandas_udf("bigint")
    def sequence(kind: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(bins.place(kind.to_numpy(), rank.to_numpy())[0])

    # Stored, so that ranks, which follow from stored rows alone, are not worked out again for each reader.
    placed = stored(packing.ranked(items).withColumn("sequence_id", sequence("kind", "rank")), "two-fit-places")
    before = Window.partitionBy("sequence_id").orderBy(F.col("kind").desc(), "row", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    seated = placed.select(
        "row", "chunk", "sequence_id", F.coalesce(F.sum("kind").over(before), F.lit(0)).cast("bigint").alias("offset")
    )
    return store.join(seated, ["row", "chunk"]).select(
        "doc_id", (F.col("chunk") / size).cast("int").alias("piece"), F.col("chunk").alias("start"),
        F.col("length").cast("bigint").alias("length"), "doc_tokens", "sequence_id", "offset", "width", "ids",
    )
