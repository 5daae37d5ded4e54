"""Comparing two results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "digest_bucket"


def max_abs_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(max_diff)`` of two ``(i, j, v)`` tables; a cell on one side only counts as 0 there."""
    met = a.select("i", "j", F.col("v").alias("av")).join(
        b.select("i", "j", F.col("v").alias("bv")), ["i", "j"], "full"
    )
    gap = F.abs(F.coalesce("av", F.lit(0.0)) - F.coalesce("bv", F.lit(0.0)))
    return met.agg(F.max(gap).alias("max_diff"))


#: Hash buckets of rows that are compared by digest. Their list is broadcast, so it stays short.
BUCKETS = 4096


def frame_diff(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(side, *columns, copies)``: the rows one table has more often, and how much more.

    Rows fall into hash buckets, and both tables give one digest for each
    bucket. Only rows of buckets whose digests differ are shuffled: tables that
    agree exchange digests, and a few changed rows cost their buckets. Those rows
    meet in one aggregation, combined per task before the shuffle, so a row
    repeated many times costs no more than any other.
    """
    left, right = same_types(a, b)
    open_ = F.broadcast(differing(digests(left, buckets), digests(right, buckets)))
    bucket = F.pmod(row_hashes(left)[0], F.lit(buckets)).cast("int")
    signed = left.withColumn("weight", F.lit(1).cast("bigint")).unionByName(
        right.withColumn("weight", F.lit(-1).cast("bigint"))
    )
    marked = signed.withColumn(BUCKET, bucket).join(open_, BUCKET, "left_semi").drop(BUCKET)
    gaps = marked.groupBy(*a.columns).agg(F.sum("weight").alias("gap")).filter(F.col("gap") != 0)
    side = F.when(F.col("gap") > 0, F.lit("left")).otherwise(F.lit("right"))
    return gaps.select(side.alias("side"), *a.columns, F.abs("gap").alias("copies"))


def same_types(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with the columns of ``a`` in the types their union has, so that equal values hash alike."""
    schema = a.limit(0).unionByName(b.limit(0)).schema
    left, right = (df.select(*[F.col(f.name).cast(f.dataType) for f in schema]) for df in (a, b))
    return left, right


def row_hashes(df: DataFrame) -> list[Column]:
    """Two independent 64-bit hashes of a row. Nulls count by their place, which Spark's own hash passes over."""
    seen: list[Column] = []
    for field in df.schema:
        if isinstance(field.dataType, (T.ArrayType, T.StructType)):
            seen.append(F.to_json(F.struct(field.name), {"ignoreNullFields": "false"}))
        else:
            seen += [F.col(field.name), F.col(field.name).isNull()]
    return [F.xxhash64(F.lit(salt), *seen) for salt in (1, 2)]


def digests(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n, d0 .. d3)``: rows of a bucket and sums over the 32-bit halves of their hashes, in any order.

    Sums of halves are exact up to two thousand million rows in a bucket.
    """
    hashes = row_hashes(df)
    halves = [half for h in hashes for half in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    named = df.select(F.pmod(hashes[0], F.lit(buckets)).cast("int").alias(BUCKET), *[h.alias(f"d{i}") for i, h in enumerate(halves)])
    return named.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"d{i}").alias(f"d{i}") for i in range(4)])


def differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """The buckets whose digests are not the same; a bucket without rows has none."""
    marked = one.unionByName(other).groupBy(BUCKET, "n", "d0", "d1", "d2", "d3").agg(F.count(F.lit(1)).alias("sides"))
    return marked.filter(F.col("sides") == 1).select(BUCKET).distinct()
