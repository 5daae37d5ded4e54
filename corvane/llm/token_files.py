"""Token ids of documents in files with Elias-Fano document boundaries.

Format: a Parquet folder with one row per shard. A shard holds whole documents
in ascending ``doc_id`` order (nulls last, then by hash of the text):

===========  =================================================================
bucket, seq  order of the shards
n_docs       documents of the shard
n_ids        ids of the shard, end ids included
ids          the ids, little-endian unsigned, ``width`` bytes each, no gaps
width        2 or 4
bounds       Elias-Fano code of the ``n_docs + 1`` document boundaries
doc_low      smallest doc_id of the shard
doc_ids      Elias-Fano code of ``doc_id - doc_low`` of the documents with an id
===========  =================================================================

Parquet is the container because Spark commits it safely on any store; ids and
boundaries are opaque bytes in it. Offsets over all shards come from a prefix
sum over ``n_ids``, never from the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.llm import elias_fano
from corvane.llm.common import as_batches, key_buckets, tasks
from corvane.llm.encoder import encoder

#: A shard is closed once it holds so many ids.
SHARD_IDS = 1 << 19

_SHARD = pa.schema([
    ("bucket", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("width", pa.int32()),
    ("doc_low", pa.int64()), ("doc_ids", pa.binary()), ("bounds", pa.binary()), ("ids", pa.binary()),
])
_SHARD_DDL = ("bucket int, seq int, n_docs int, n_ids bigint, width int, doc_low bigint, doc_ids binary, "
              "bounds binary, ids binary")


class _Shard:
    def __init__(self, bucket: int, seq: int, width: int):
        self.bucket, self.seq, self.width = bucket, seq, width
        self.parts: list[bytes] = []
        self.docs: list[int] = []
        self.ends = [0]

    def add(self, doc: int | None, ids: bytes) -> None:
        if doc is not None:
            self.docs.append(doc)
        self.parts.append(ids)
        self.ends.append(self.ends[-1] + len(ids) // self.width)

    def row(self) -> dict:
        low = self.docs[0] if self.docs else 0
        # Differences fit unsigned 64 bits even where they overflow signed ones.
        docs = np.array(self.docs, dtype=np.int64).view(np.uint64) - np.array(low, dtype=np.int64).view(np.uint64)
        return {
            "bucket": self.bucket, "seq": self.seq, "n_docs": len(self.ends) - 1, "n_ids": self.ends[-1],
            "width": self.width, "doc_low": low, "doc_ids": elias_fano.encode(docs),
            "bounds": elias_fano.encode(np.array(self.ends)), "ids": b"".join(self.parts),
        }


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, spaces: str = "lead", shard_ids: int = SHARD_IDS) -> None:
    """Encodes ``doc_id, text`` (null text: no ids) and writes the format above to ``path``.

    Every document ends with ``end_id``. Repeated and null ids are kept as rows
    of their own. An empty table writes an empty folder. Other columns are ignored.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaces)
        end = np.array([end_id], dtype=encode.dtype).tobytes()

        def rows() -> Iterator[dict]:
            open_: _Shard | None = None
            for batch in batches:
                for bucket, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if open_ is None or open_.bucket != bucket or open_.ends[-1] >= shard_ids:
                        seq = 0
                        if open_ is not None:
                            yield open_.row()
                            seq = open_.seq + 1 if open_.bucket == bucket else 0
                        open_ = _Shard(bucket, seq, encode.width)
                    open_.add(doc, encode.encode(text) + end)
            if open_ is not None:
                yield open_.row()

        yield from as_batches(rows(), _SHARD, 1000)

    marked, _ = key_buckets(docs.select("doc_id", "text"), "doc_id", F.xxhash64("text"))
    order = ["bucket", F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    seated = (
        marked.select("bucket", F.col("doc_id").cast("bigint"), "text")
        .repartition(tasks(docs.sparkSession), "bucket").sortWithinPartitions(*order)
    )
    seated.mapInArrow(shards, _SHARD_DDL).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (binary, little-endian unsigned 32-bit) of all documents of a folder."""
    shards = spark.read.schema(_SHARD_DDL).parquet(path)
    schema = pa.schema([
        ("bucket", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("inside", pa.int64()),
        ("n_tokens", pa.int64()), ("ids", pa.binary()),
    ])
    ddl = "bucket int, seq int, doc_id bigint, inside bigint, n_tokens bigint, ids binary"

    def open_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                    for doc, start, ids in documents(shard):
                        yield {"bucket": shard["bucket"], "seq": shard["seq"], "doc_id": doc, "inside": start,
                               "n_tokens": len(ids), "ids": ids.astype("<u4").tobytes()}

        yield from as_batches(rows(), schema)

    opened = shards.mapInArrow(open_shards, ddl)
    return opened.join(starts(shards), ["bucket", "seq"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids"
    )


def documents(shard: dict) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(doc_id, start in the shard, ids)`` of the documents of a shard row."""
    bounds = elias_fano.EliasFano(shard["bounds"]).values()
    low = np.array(shard["doc_low"], dtype=np.int64).view(np.uint64)
    docs = (elias_fano.EliasFano(shard["doc_ids"]).values().view(np.uint64) + low).view(np.int64).tolist()
    ids = np.frombuffer(shard["ids"], dtype=f"<u{shard['width']}")
    for i in range(shard["n_docs"]):
        yield (docs[i] if i < len(docs) else None), int(bounds[i]), ids[bounds[i] : bounds[i + 1]]


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read from the files; ids stay in the task that reads them."""
    shards = spark.read.schema(_SHARD_DDL).parquet(path)
    schema = pa.schema([
        ("bucket", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("inside", pa.int64()),
        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
    ])
    ddl = "bucket int, seq int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                found = [(d, s, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, s, x in documents(shard)]
                doc, start, n, crc = zip(*found, strict=True)
                both = [[shard["bucket"]] * len(found), [shard["seq"]] * len(found)]
                columns = zip([*both, doc, start, n, crc], schema.types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns], schema=schema)

    return shards.mapInArrow(sums, ddl).join(starts(shards), ["bucket", "seq"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def starts(shards: DataFrame) -> DataFrame:
    """``bucket, seq, base``: ids before each shard. Only the size columns are read.

    The window over all buckets sees one row per bucket, eight per write task.
    """
    sizes = shards.select("bucket", "seq", "n_ids")
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    of_bucket = sizes.groupBy("bucket").agg(F.sum("n_ids").alias("all")).select(
        "bucket", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("bucket").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("bucket", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("part")).join(
        of_bucket, "bucket"
    ).select("bucket", "seq", (F.col("before") + F.col("part")).alias("base"))
