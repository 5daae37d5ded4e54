"""Packing documents into training sequences by cutting stock.

A document's ids are cut into chunks of ``size`` ids and a rest. Chunks and
rests are items; their lengths, rounded up to multiples of ``grain``, make a
histogram of at most ``size / grain`` classes, which is all the planner sees.
:mod:`corvane.llm.cutting_stock` gives patterns of classes that fill a
sequence and how often to use each. Items are ranked inside their class, and
the rank alone says which use of which pattern an item belongs to.

Items past the whole uses (fewer than one use of each pattern, whatever the
corpus) are laid end to end and cut at ``size``; what remains at the end is cut
into sequences of falling powers of two, which need no padding.

Null and empty texts are documents of the end id alone. Rows are packed as they
are: repeated ids and texts are items of their own. An empty table gives none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corvane.llm.common import stored, tasks
from corvane.llm.cutting_stock import patterns
from corvane.llm.encoder import encoder

SIZE = 4096
GRAIN = 16

_CHUNK = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("length", pa.int32()),
    ("doc_tokens", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()),
])
_CHUNK_DDL = "row bigint, doc_id bigint, chunk bigint, length int, doc_tokens bigint, width int, ids binary"


def chunks(docs: DataFrame, tokenizer: str, end_id: int, spaces: str, size: int = SIZE) -> DataFrame:
    """``row, doc_id, chunk, length, doc_tokens, width, ids``; ``chunk`` is where it starts in its document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaces)
        width = encode.width
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        for batch in batches:
            columns: list[list] = [[] for _ in _CHUNK]
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encode.encode(text) + end
                n = len(ids) // width
                for start in range(0, n, size):
                    part = ids[start * width : (start + size) * width]
                    values = (row, doc, start, len(part) // width, n, width, part)
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _CHUNK, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_CHUNK)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), "text")
    return numbered.mapInArrow(cut, _CHUNK_DDL)


def ranked(items: DataFrame) -> DataFrame:
    """Adds ``rank``, the 0-based place of an item in its class.

    A class is dealt into hash buckets; ranks inside a bucket are added to the
    counts of the buckets before, so a class of any size is ranked by many tasks.
    """
    dealt = items.withColumn("bucket", F.pmod(F.xxhash64("row", "chunk"), F.lit(4 * tasks(items.sparkSession))).cast("int"))
    earlier = Window.partitionBy("kind").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("kind", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "kind", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("kind", "bucket").orderBy("row", "chunk")
    return dealt.withColumn("inside", F.row_number().over(inside) - 1).join(before, ["kind", "bucket"]).select(
        *items.columns, (F.col("before") + F.col("inside")).cast("bigint").alias("rank")
    )


class Plan:
    """Where the item with a class and a rank goes."""

    def __init__(self, histogram: dict[int, int], size: int = SIZE, grain: int = GRAIN):
        self.kinds = np.array(sorted(histogram), dtype=np.int64)
        demand = np.array([histogram[k] for k in self.kinds.tolist()])
        self.columns, self.uses = patterns(self.kinds, demand, size // grain)
        self.sequences = int(self.uses.sum())
        base = np.concatenate([[0], np.cumsum(self.uses)])
        self.spans: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for at, kind in enumerate(self.kinds.tolist()):
            having = np.flatnonzero(self.columns[:, at]) if len(self.columns) else np.zeros(0, dtype=np.int64)
            ends = np.cumsum(self.columns[having, at] * self.uses[having]) if len(having) else np.zeros(0, dtype=np.int64)
            self.spans[kind] = (ends, base[having], self.uses[having])

    def place(self, kind: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(sequence, slot)`` of items; sequence -1 is past the whole uses."""
        sequence = np.full(len(kind), -1, dtype=np.int64)
        slot = np.zeros(len(kind), dtype=np.int64)
        for k in np.unique(kind):
            ends, base, uses = self.spans[int(k)]
            at = np.flatnonzero(kind == k)
            at = at[rank[at] < (ends[-1] if len(ends) else 0)]
            if not len(at):
                continue
            span = np.searchsorted(ends, rank[at], side="right")
            inside = rank[at] - np.where(span > 0, ends[span - 1], 0)
            sequence[at] = base[span] + inside % uses[span]
            slot[at] = int(k) * 1000 + inside // uses[span]
        return sequence, slot


def tail_cuts(total: int, size: int) -> np.ndarray:
    """Ends of the sequences over ``total`` ids in a line: whole ones, then falling powers of two."""
    ends = list(range(size, total + 1, size))
    at = total // size * size
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        ends.append(at)
    return np.array(ends, dtype=np.int64)


def pack(docs: DataFrame, tokenizer: str, end_id: int, spaces: str = "drop", size: int = SIZE, grain: int = GRAIN) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, width, ids``.

    ``ids`` are little-endian unsigned integers of ``width`` bytes. Offsets in
    a sequence have no gaps.
    """
    store = stored(chunks(docs, tokenizer, end_id, spaces, size), "packing-chunks")
    items = store.select("row", "chunk", "length", F.ceil(F.col("length") / grain).cast("int").alias("kind"))
    histogram = {r["kind"]: r["count"] for r in items.groupBy("kind").count().collect()}
    plan = Plan(histogram, size, grain)

    @pandas_udf("struct<sequence:bigint,slot:bigint>")
    def place(kind: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, slot = plan.place(kind.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence": sequence, "slot": slot})

    placed = stored(ranked(items).withColumn("at", place("kind", "rank")).select(
        "row", "chunk", "length", "kind", "rank", F.col("at.sequence").alias("sequence_id"), F.col("at.slot").alias("slot")
    ), "packing-places")
    whole = placed.filter("sequence_id >= 0").select(
        "row", "chunk", F.lit(0).cast("bigint").alias("inside"), F.col("length").cast("bigint").alias("length"), "sequence_id", "slot"
    )
    met = whole.union(line_pieces(placed.filter("sequence_id < 0"), plan.sequences, size))
    order = Window.partitionBy("sequence_id").orderBy("slot", "row", "chunk", "inside").rowsBetween(Window.unboundedPreceding, -1)
    seated = met.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)).cast("bigint"))
    ids = F.substring(F.col("ids"), (F.col("inside") * F.col("width") + 1).cast("int"), (seated["length"] * F.col("width")).cast("int"))
    return store.drop("length").join(seated, ["row", "chunk"]).select(
        "doc_id", (F.col("chunk") + F.col("inside")).alias("start"), "length", "doc_tokens", "sequence_id", "offset", "width",
        ids.alias("ids"),
    )


def line_pieces(rest: DataFrame, first_sequence: int, size: int) -> DataFrame:
    """Pieces of the items that no whole pattern took.

    There are fewer of them than items in one use of every pattern, a number
    that the classes bound and the corpus does not, so one window may order them.
    """
    line = Window.orderBy(F.col("kind").desc(), "rank")
    laid = rest.withColumn("end", F.sum("length").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    total = rest.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    ends = tail_cuts(total, size)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row, chunk, length, end in batch[["row", "chunk", "length", "end"]].itertuples(index=False):
                start = at = end - length
                while at < end:
                    sequence = int(np.searchsorted(ends, at, side="right"))
                    stop = min(end, int(ends[sequence]))
                    rows.append((row, chunk, at - start, stop - at, first_sequence + sequence, at))
                    at = stop
            yield pd.DataFrame(rows, columns=["row", "chunk", "inside", "length", "sequence_id", "slot"])

    return laid.mapInPandas(cut, "row bigint, chunk bigint, inside bigint, length bigint, sequence_id bigint, slot bigint")


def crc32(ids: Column, width: Column) -> Column:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""

    @pandas_udf("bigint")
    def of(raw: pd.Series, bytes_: pd.Series) -> pd.Series:
        return pd.Series([
            zlib.crc32(np.frombuffer(r, dtype=f"<u{w}").astype("<u4").tobytes()) for r, w in zip(raw, bytes_, strict=True)
        ], dtype="int64")

    return of(ids, width)
