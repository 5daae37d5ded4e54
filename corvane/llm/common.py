"""Pieces that several operators of this package use."""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.session import scratch_path

#: A word: everything between the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read back: no lineage, any executor can read it."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(*frames: DataFrame) -> None:
    """Deletes the files of frames from :func:`stored` that nothing will read again."""
    for frame in frames:
        jvm = frame.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_buckets(df: DataFrame, key: str, tie: Column, per_task: int = 8, name: str = "bucket") -> tuple[DataFrame, int]:
    """Adds ascending range buckets of a numeric key, nulls after all others, rows of one key by the 64-bit hash ``tie``.

    Only the key column is scanned for the bounds. There are ``per_task``
    buckets for each shuffle task, so that buckets dealt by hash even out. A key
    that fills several buckets, or very many nulls, are cut into as many ranges
    of the hash; up to there equal keys share a bucket. (Keys of 2**53 and above
    are never cut, as bounds are doubles.) Returns the frame and the number of
    buckets.
    """
    n = tasks(df.sparkSession) * per_task
    probes = [i / n for i in range(1, n)]
    only = df.select(F.col(key).cast("double").alias("at"))
    rows = only.agg(F.count(F.lit(1)).alias("all"), F.count("at").alias("there")).first()
    found = Counter(only.dropna().approxQuantile("at", probes, 0.25 / n))
    bounds = sorted(found)
    splits = [float("-inf"), *bounds, float("inf")]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    marked = df.withColumn("__at", F.col(key).cast("double"))
    cut = Bucketizer(splits=splits, inputCol="__at", outputCol="__bucket", handleInvalid="keep")
    last = len(splits) - 1
    at = F.when(F.col("__at").isNull(), F.lit(last)).otherwise(F.col("__bucket").cast("int"))
    # A bound that several probes hit is one key; its own buckets come before the rest of its range.
    own = [found[low] if found.get(low, 0) > 1 and abs(low) < 1 << 53 else 0 for low in splits[:-1]]
    nulls = max(1, math.ceil((rows["all"] - rows["there"]) * n / max(1, rows["all"])))
    before = list(itertools.accumulate([parts + 1 for parts in own], initial=0))
    ordered = cut.transform(marked).withColumn("__bucket", at)
    if len(before) == before[-1] + 1 and nulls == 1:
        return ordered.withColumnRenamed("__bucket", name).drop("__at"), last + 1

    def look(values: list) -> Column:
        return F.element_at(F.lit(values), F.col("__bucket") + 1)

    parts = look([*own, nulls]).cast("bigint")
    hot = F.col("__at").isNull() | (F.col("__at") == look([*splits[:-1], 0.0]))
    # The upper 31 bits of the hash, in its order, as a place among the parts.
    place = F.shiftright((F.shiftright(tie, 33) + F.lit(1 << 30)) * parts, 31)
    inside = F.when(F.col("__at").isNull() | (hot & (parts > 0)), place).otherwise(parts)
    return ordered.withColumn(name, (look(before) + inside).cast("int")).drop("__at", "__bucket"), before[-1] + nulls


def as_batches(rows: Iterator[dict], schema: pa.Schema, most_rows: int = 5000, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded size from single rows; sizes count binary and string cells only."""
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, (bytes, str)))
        if len(held) >= most_rows or size >= most_bytes:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)
