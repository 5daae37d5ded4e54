"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Sources in code point order (null last, as a source of its own) take the
weights in turn. The mix holds ``total`` times all words. A source gets at most
``epochs`` times its words; what it cannot take goes to the others in
proportion to their weights until no source is above its cap.

A source with target ``t`` and size ``s`` gives each document ``t // s`` times
whole. The rest of the target is filled by one more repetition of documents in
an order drawn from a seed and the id; the document at the boundary gives the
first words it still needs. So each source meets its target to the word, and
no document passes ``epochs`` times its size. The draw depends on row values
alone: reruns agree, equal rows are interchangeable. Null texts have size 0; a
source without words gets and gives nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import WORD, stored, word_count
from corvane.operators.ranking import global_rank
from corvane.session import frozen

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
EPOCHS = 2
SEED = "mix-1"


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Adds ``size``, the draw (``__draw``, ``__tie``), its ``__bucket`` (1 of 4096) and a source key that is never null."""
    digest = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return docs.withColumns({
        "size": word_count(F.col("text")),
        "__source": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
        "__draw": F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"),
        "__bucket": F.conv(F.substring(digest, 1, 3), 16, 10).cast("int"),
        "__tie": F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
    })


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, epochs: int = EPOCHS) -> DataFrame:
    """``__source, source_size, target`` from ``__source, source, size`` rows.

    The water level only rises, and each round costs one aggregate over the
    table of sources; sources themselves never come to the driver.
    """
    per_source = sizes.groupBy("__source", "source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(per_source, [F.col("source").asc_nulls_last()])
    turn = ((F.col("rank") - 1) % len(weights) + 1).cast("int")
    table = frozen(ranked.select(
        "__source", "source_size", F.element_at(F.array(*map(F.lit, weights)), turn).alias("weight"),
        (F.col("source_size") * epochs).alias("cap"),
    ))
    level = water_level(table, total)
    wanted = F.lit(level) * F.col("weight")
    return table.select(
        "__source", "source_size",
        F.when(F.col("cap") <= wanted, F.col("cap").cast("double")).otherwise(wanted).alias("target"),
    )


def water_level(table: DataFrame, total: float) -> float:
    """Words per unit of weight for the sources that stay below their cap."""
    sums = table.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    if not sums["words"]:
        return 0.0
    goal = total * sums["words"]
    level, full = goal / sums["weight"], -1
    while True:
        above = F.col("cap") <= F.lit(level) * F.col("weight")
        now = table.agg(
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)).alias("cap"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
            F.coalesce(F.sum(above.cast("int")), F.lit(0)).alias("full"),
        ).first()
        if now["full"] == full or not now["weight"]:
            return level
        level, full = (goal - now["cap"]) / now["weight"], now["full"]


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size, source_size, target, whole, part``: repetitions in full, and words of one more.

    Columns of those names are replaced.

    A source of any size is cut into 4096 hash buckets; running sums are taken
    inside buckets and added to the sums of the buckets before.
    """
    # The plan of the mix needs four narrow columns; texts are read again by whoever keeps them.
    narrow = stored(sized(docs.select("doc_id", "text", "source"), seed).select("__source", "source", "__bucket", "size"), "mix-sizes")
    want = targets(narrow, weights, total, epochs)
    earlier = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = narrow.groupBy("__source", "__bucket").agg(F.sum("size").alias("all")).select(
        "__source", "__bucket", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("__before")
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    plan = buckets.join(want, "__source").withColumn("whole", whole).withColumn(
        "__rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("bigint")
    )
    drawn = Window.partitionBy("__source", "__bucket").orderBy("__draw", "size", "__tie").rowsBetween(Window.unboundedPreceding, -1)
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "whole", "part")]
    running = sized(docs.select(*kept), seed).withColumn("__inside", F.coalesce(F.sum("size").over(drawn), F.lit(0)))
    left = F.col("__rest") - F.col("__before") - F.col("__inside")
    part = F.least(F.greatest(left, F.lit(0)), F.col("size"))
    return running.join(plan, ["__source", "__bucket"]).withColumn("part", part).select(
        *kept, "size", "source_size", "target", "whole", "part"
    )


def taken() -> Column:
    return F.col("whole") * F.col("size") + F.col("part")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per repetition; a partial one keeps the first ``part`` words with their white space.

    ``n_chars`` follows a shortened text.
    """
    pieces = F.split("text", rf"(?<={WORD[:-1]})(?=[\x20\x09-\x0D])")
    short = F.array_join(F.slice(pieces, 1, F.col("part").cast("int")), "")
    partial = (F.col("part") > 0) & (F.col("part") < F.col("size"))
    times = F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0)
    copies = mixed.filter(times > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), times.cast("int"))))
    cut = partial & (F.col("__copy") > F.col("whole"))
    out = copies.withColumn("text", F.when(cut, short).otherwise(F.col("text")))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("bigint"))
    return out.select(*columns)
