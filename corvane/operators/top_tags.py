"""The most similar tags of each tag, exact, without the table of all pairs.

The similarity of two tags is the sum over words of the product of their
counts. For a tag, no partner gains more from a word than the tag's count times
the largest count another tag has there: the word's gain. Words are ordered by
gain for each posting they would bring, in steps of powers of two. Words of the
first steps, the head, are joined with all their postings. The rest of the words
is left out where all its gains together stay below what the k-th best partner
has for certain: then every partner that matters shares a word of the head.
Partial sums over the head are lower bounds, and with the gains of the rest
upper bounds, so most partners are ruled out before the rest of their words is
looked up. What is left is summed exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.operators import chunks
from corvane.session import frozen

# Words of a tag, at least, over which the first certain similarities are summed.
FIRST_WORDS = 32


@dataclass
class Search:
    """``ranked (tag, rank, other, similarity)``, ``head (tag, word, cnt)`` joined with all postings, ``verified (tag, other, partial)``."""

    ranked: DataFrame
    head: DataFrame
    verified: DataFrame


def most_similar(counts: DataFrame, k: int, chunk_rows: int = chunks.CHUNK_ROWS) -> DataFrame:
    """``(tag, rank, other, similarity)``: the ``k`` most similar tags of each tag, of those that share a word with it.

    ``counts`` is ``(tag, word, cnt)``, one row per tag and word, counts from 1.
    Ranks follow similarity downwards, then the other tag upwards.
    """
    return search(counts, k, chunk_rows).ranked


def search(counts: DataFrame, k: int, chunk_rows: int = chunks.CHUNK_ROWS) -> Search:
    """:func:`most_similar` with its tables on the way."""
    words = frozen(gains(counts))
    steps = frozen(step_sums(words))
    # What the first words alone give is certain.
    few = words.join(steps.filter(F.col("earlier") < FIRST_WORDS).select("tag", "step"), ["tag", "step"], "left_semi")
    certain = _kth(partial_sums(few, words, chunk_rows), k)
    # A step is in the head unless it and all steps after it cannot reach what is certain.
    rest = steps.join(certain, "tag", "left").filter(F.col("below") < F.coalesce("kth", F.lit(0))).select("tag", "step", "below")
    rest = frozen(rest)
    marked = frozen(words.join(rest.select("tag", "step", F.lit(True).alias("left_out")), ["tag", "step"], "left"))
    head = marked.filter(F.col("left_out").isNull()).select("tag", "word", "cnt")
    partial = frozen(partial_sums(head, words, chunk_rows))
    open_ = partial.join(rest.groupBy("tag").agg(F.max("below").alias("room")), "tag", "left").join(_kth(partial, k), "tag", "left")
    above = F.col("partial") + F.coalesce("room", F.lit(0)) >= F.coalesce("kth", F.lit(0))
    verified = frozen(open_.filter(above).select("tag", "other", "partial"))
    added = _rest_sums(verified, marked.filter("left_out"), words)
    exact = verified.join(added, ["tag", "other"], "left").withColumn(
        "similarity", F.col("partial") + F.coalesce("added", F.lit(0))
    )
    place = F.row_number().over(Window.partitionBy("tag").orderBy(F.col("similarity").desc(), "other"))
    ranked = exact.withColumn("rank", place).filter(F.col("rank") <= k).select("tag", "rank", "other", "similarity")
    return Search(ranked, head, verified)


def gains(counts: DataFrame) -> DataFrame:
    """``(tag, word, cnt, gain, step)`` of the words that another tag has as well; a low step is looked at first."""
    top = counts.groupBy("word").agg(F.max(F.struct("cnt", "tag")).alias("top"), F.count(F.lit(1)).alias("tags")).filter("tags > 1")
    met = chunks.salted_lookup(counts.select("tag", "word", "cnt"), top, "word", "tag", "inner")
    others = met.filter(F.col("tag") != F.col("top.tag")).groupBy("word").agg(F.max("cnt").alias("second"))
    both = chunks.salted_lookup(met, others, "word", "tag", "inner")
    most = F.when(F.col("tag") == F.col("top.tag"), F.col("second")).otherwise(F.col("top.cnt"))
    gain = F.col("cnt") * most
    return both.select("tag", "word", "cnt", gain.alias("gain"), (-F.floor(F.log2(gain / F.col("tags")))).cast("int").alias("step"))


def step_sums(words: DataFrame) -> DataFrame:
    """``(tag, step, earlier, below)``: words of the earlier steps, and the gains of this step and all later ones.

    Steps are powers of two of a 64-bit number, so a tag has no more than about a hundred of them.
    """
    sums = words.groupBy("tag", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("gain").alias("gain"))
    along = Window.partitionBy("tag").orderBy("step")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    onward = along.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return sums.select(
        "tag", "step", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"), F.sum("gain").over(onward).alias("below")
    )


def partial_sums(some: DataFrame, words: DataFrame, chunk_rows: int) -> DataFrame:
    """``(tag, other, partial)`` summed over the words of ``some``, with all tags that have them."""
    left = some.select("word", "tag", "cnt")
    right = words.select("word", F.col("tag").alias("other"), F.col("cnt").alias("other_cnt"))
    met = chunks.chunked_join(left, right, "word", ("tag", "other"), ("cnt", "other_cnt"), chunk_rows)
    return met.filter(F.col("tag") != F.col("other")).groupBy("tag", "other").agg(
        F.sum(F.col("cnt") * F.col("other_cnt")).alias("partial")
    )


def _kth(partial: DataFrame, k: int) -> DataFrame:
    """``(tag, kth)``: the k-th largest partial sum of the tags that have so many."""
    # Spark cuts each task's rows of a tag at k before they meet.
    place = F.row_number().over(Window.partitionBy("tag").orderBy(F.col("partial").desc()))
    best = partial.select("tag", "partial").withColumn("place", place).filter(F.col("place") <= k)
    return best.filter(F.col("place") == k).select("tag", F.col("partial").alias("kth"))


def _rest_sums(pairs: DataFrame, rest: DataFrame, words: DataFrame) -> DataFrame:
    """``(tag, other, added)`` over the words left out so far, for ``pairs`` only."""
    # A tag with very many words is spread over tasks by word; its partners are repeated for each.
    asked = chunks.salted_lookup(rest.select("tag", "word", "cnt"), pairs.select("tag", "other"), "tag", "word", "inner")
    found = words.select(F.col("tag").alias("other"), "word", F.col("cnt").alias("other_cnt"))
    return asked.join(found, ["other", "word"]).groupBy("tag", "other").agg(
        F.sum(F.col("cnt") * F.col("other_cnt")).alias("added")
    )
