"""Joins inside a key whose work is the product of two groups, split evenly.

A self-join or a sparse product on one key costs (rows left) x (rows right) for
that key. Large groups are cut into chunks and every chunk pair becomes a join
key of its own, so one popular key spreads over many tasks. Every pair still
meets exactly once; nothing is capped or dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A chunk pair costs at most this many rows squared.
CHUNK_ROWS = 1024
# Tasks that share the rows of one key when something is looked up for it.
SALTS = 32


def parts_per_key(table: DataFrame, key: str, chunk_rows: int, value: str, name: str = "parts") -> DataFrame:
    """Keys larger than one chunk, with the number of chunks they need.

    ``value`` is never null. Testing its maximum changes no result, but makes
    this branch ask for the same columns as the join does, so that both reuse
    one shuffle; counting alone would compute the table a second time.
    """
    return (
        table.groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"), F.max(value).alias("peak"))
        .filter((F.col("rows") > chunk_rows) & F.col("peak").isNotNull())
        .select(key, F.ceil(F.col("rows") / F.lit(chunk_rows)).cast("int").alias(name))
    )


def salted_lookup(rows: DataFrame, table: DataFrame, key: str, item: str, how: str = "left", salts: int = SALTS) -> DataFrame:
    """``rows`` joined with the one row per key of ``table``, without gathering a key in one task.

    Rows of a key are spread by a hash of ``item`` over ``salts`` tasks, and the
    lookup row is repeated for each. A lookup table small enough to broadcast is
    left to adaptive execution.
    """
    salted = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64(F.col(item)), F.lit(salts)).cast("int"), F.lit(0)))
    every = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(every, [key, "salt"], how).drop("salt")


def chunk_of(item: Column, parts: Column) -> Column:
    # Never null, and declared so: otherwise the join infers a null test on the
    # chunk, which moves down to the source and parts the branches again.
    return F.coalesce(F.pmod(F.xxhash64(item), parts).cast("int"), F.lit(0))


def mark_by_key(table: DataFrame, key: str, item: str, value: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds ``parts`` and ``chunk``; only oversized keys have more than one part."""
    # No hint here: adaptive execution measures the list of large keys and
    # broadcasts it only when it is small.
    sized = salted_lookup(table, parts_per_key(table, key, chunk_rows, value), key, item)
    parts = F.coalesce(F.col("parts"), F.lit(1))
    return sized.withColumn("parts", parts).withColumn("chunk", chunk_of(F.col(item), F.col("parts")))


def spread_pairs(rows: DataFrame, on: list[str]) -> DataFrame:
    """Partitions by chunk pair. The number is given, because few input rows make
    many output rows here and adaptive execution would merge partitions by input."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *on)


def unordered_pairs(marked: DataFrame, keys: list[str], item: str, value: str | None = None) -> DataFrame:
    """All pairs of different items below each key, as ``a < b`` [with ``va``, ``vb``].

    Items are unique below a key. Pairs inside a chunk come from one shuffle that
    both sides of the join read; chunk i meets chunk j > i once, and only large
    keys have such rows.
    """
    values = [value] if value else []

    def side(rows: DataFrame, name: str, *at: Column | str) -> DataFrame:
        return rows.select(*keys, *at, F.col(item).alias(name), *[F.col(v).alias(f"v{name}") for v in values])

    home = marked.select(*keys, "chunk", item, *values).repartition(*keys, "chunk")
    same = side(home, "a", "chunk").join(side(home, "b", "chunk"), [*keys, "chunk"]).filter(F.col("a") < F.col("b"))

    # Partition by the chunk pair, not by the key alone: this is what spreads a
    # large key. sequence() counts down when its end is below its start, hence
    # the filters.
    on = [*keys, "lo", "hi"]
    above = F.explode(F.sequence(F.col("chunk") + 1, F.col("parts") - 1)).alias("hi")
    below = F.explode(F.sequence(F.lit(0), F.col("chunk") - 1)).alias("lo")
    large = marked.filter(F.col("parts") > 1)
    low = side(large.filter(F.col("chunk") < F.col("parts") - 1), "a", F.col("chunk").alias("lo"), above)
    high = side(large.filter(F.col("chunk") > 0), "b", below, F.col("chunk").alias("hi"))
    cross = spread_pairs(low, on).join(spread_pairs(high, on), on)

    met = same.drop("chunk").unionByName(cross.drop("lo", "hi"))
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    if value:
        swap = F.col("a") > F.col("b")
        ordered += [
            F.when(swap, F.col("vb")).otherwise(F.col("va")).alias("va"),
            F.when(swap, F.col("va")).otherwise(F.col("vb")).alias("vb"),
        ]
    return met.select(*keys, *ordered)


def chunked_join(
    left: DataFrame, right: DataFrame, key: str, items: tuple[str, str], values: tuple[str, str],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Equi-join on ``key`` with both sides of oversized keys cut into chunks."""
    sizes = parts_per_key(left, key, chunk_rows, values[0], "lp").join(
        parts_per_key(right, key, chunk_rows, values[1], "rp"), key, "full"
    )
    lp = F.coalesce(F.col("lp"), F.lit(1))
    rp = F.coalesce(F.col("rp"), F.lit(1))

    def cells(side: DataFrame, item: str, own: Column, other: Column, own_name: str, other_name: str) -> DataFrame:
        sized = salted_lookup(side, sizes, key, item)
        return sized.select(
            *side.columns,
            chunk_of(F.col(item), own).alias(own_name),
            F.explode(F.sequence(F.lit(0), other - 1)).alias(other_name),
        )

    on = [key, "lc", "rc"]
    a = cells(left, items[0], lp, rp, "lc", "rc")
    b = cells(right, items[1], rp, lp, "rc", "lc")
    return spread_pairs(a, on).join(spread_pairs(b, on), on).drop("lc", "rc")
