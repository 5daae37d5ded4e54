"""Total order over a large table without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.session import frozen

LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row below


def _seated(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows sorted over the whole table, with their ``part`` and their ``seat``, which rises in order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seated = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("seat", F.monotonically_increasing_id())
    )
    return frozen(seated).withColumn("part", F.shiftright("seat", LOCAL_BITS))


def running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows before each row in ``order``; one sum per partition is added up."""
    seated = _seated(df, order)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = seated.groupBy("part").agg(F.sum(value).alias("all"))
    before = sums.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seat").rowsBetween(Window.unboundedPreceding, -1)
    return seated.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(F.broadcast(before), "part").select(
        *df.columns, (F.col("before") + F.col("inside")).alias(name)
    )


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the 1-based position of each row in ``order`` over the whole table.

    Range partitioning sorts in parallel; only one row count per partition is
    summed up. The sorted rows are checkpointed first, because range bounds are
    sampled and must not move between the two passes.
    """
    seated = _seated(df, order)
    sizes = seated.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    # One row per partition: the number of shuffle partitions bounds this side
    # and the window over it.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    local = F.col("seat").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    return seated.join(F.broadcast(before), "part").select(
        *df.columns, (F.col("before") + local + 1).alias(name)
    )
