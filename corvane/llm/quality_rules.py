"""Quality rules of a text, and lines that many documents of a host share.

DataFrame functions only. A line counts as boilerplate of its host when it
stands in more distinct documents than both ``min_docs`` and ``share`` of the
host's documents. Such lines are taken out of every document but the first one
(lowest ``doc_id``) that bears them, so that no text leaves the corpus. A
document that keeps less than ``left`` of its words is rejected as depleted.

Counting is by content: rows with equal texts are one document. Lines are
compared lower-cased with runs of white space as one blank; lines without a
word are never counted. Null texts count as empty: no words, base rules fail.
Null hosts form one host of their own; null ids come after all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import WORD, stored

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"

MIN_DOCS = 30
SHARE = 0.01
LEFT = 0.3


def words(text: Column) -> Column:
    """Array of the words of a text, without the split's empty ends."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def windows(found: Column, size: int = WINDOW) -> Column:
    """64-bit hashes of all windows of ``size`` words; none for shorter arrays."""

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (size - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, size)))

    return F.when(F.size(found) >= size, let(found, hashes)).otherwise(F.array().cast("array<bigint>"))


def repeated_words(hashes: Column, size: int = WINDOW) -> Column:
    """Words inside windows that stand in the array twice or more, first ones included.

    Most texts repeat none, and stop at the comparison of distinct and all windows.
    """
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_covered(hashes, size))


def _covered(hashes: Column, size: int) -> Column:
    ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Each start adds the words that the one before has not covered.
    total = F.aggregate(
        F.array_sort(let(ranked, _repeated)),
        F.struct(F.lit(-size).alias("last"), F.lit(0).alias("sum")),
        lambda acc, p: F.struct(
            p.alias("last"), (acc["sum"] + F.least(F.lit(size), p - acc["last"])).alias("sum")
        ),
    )
    return total["sum"]


def _repeated(ranked: Column) -> Column:
    """Positions whose hash equals a neighbour's in the sorted array."""

    def shared(x: Column, k: Column) -> Column:
        before, after = F.get(ranked, k - 1)["h"], F.get(ranked, k + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

    return F.transform(F.filter(ranked, shared), lambda x: x["i"])


def features(docs: DataFrame) -> DataFrame:
    """Base measures of each row, its key columns and its line hashes; the text itself is left behind.

    Columns: ``row, doc_id, host, text_hash, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, lines``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    normal = lambda line: F.lower(F.regexp_replace(F.btrim(line, F.lit(SPACES)), SPACE_RUN, " "))
    split = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        host(F.col("source")).alias("host"), F.xxhash64(text).alias("text_hash"),
        words(text).alias("words"), F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("bare"),
    )
    cut = split.select(
        "row", "doc_id", "host", "text_hash", "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        windows(F.col("words")).alias("windows"),
        (F.size("bare") - F.size(F.array_distinct("bare"))).cast("bigint").alias("n_dup_lines"),
        F.transform(F.transform("bare", normal), lambda line: F.struct(
            F.xxhash64(line).alias("hash"), F.size(F.split(line, " ")).alias("n"),
        )).alias("lines"),
    )
    counted = cut.withColumn("n_repeat_words", repeated_words(F.col("windows")).cast("bigint")).drop("windows")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def host(source: Column) -> Column:
    """A key that is never null and keeps null apart from the empty string."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def frequent_lines(table: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """``host, hash, first_doc, first_text`` of the lines above the limits.

    Each document gives a line once, and equal texts are merged before the
    counts meet, so a line of a very common host is summed up before it moves.
    """
    per_text = (
        table.select("host", "text_hash", "doc_id", F.explode(F.array_distinct("lines.hash")).alias("hash"))
        .groupBy("host", "hash", "text_hash").agg(F.min("doc_id").alias("doc_id"))
    )
    bearer = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("doc"), F.col("text_hash").alias("text"))
    counts = per_text.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n_docs"), F.min(bearer).alias("first"))
    hosts = table.groupBy("host", "text_hash").agg(F.count(F.lit(1))).groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    return counts.filter(F.col("n_docs") > min_docs).join(hosts, "host").filter(
        F.col("n_docs") > F.col("of") * share
    ).select("host", "hash", F.col("first.doc").alias("first_doc"), F.col("first.text").alias("first_text"))


def judged(table: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, left: float = LEFT) -> DataFrame:
    """Adds ``removed_words``, ``removed`` (hashes of the lines taken out), ``kept`` to stored features."""
    common = frequent_lines(table, min_docs, share)
    lines = table.select("row", "host", "doc_id", "text_hash", F.explode("lines").alias("line")).select(
        "row", "host", "doc_id", "text_hash", F.col("line.hash").alias("hash"), F.col("line.n").alias("n")
    )
    first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("text_hash") == F.col("first_text"))
    gone = lines.join(common, ["host", "hash"]).filter(~first).groupBy("row").agg(
        F.sum("n").alias("removed_words"), F.collect_set("hash").alias("removed")
    )
    taken = F.coalesce("removed_words", F.lit(0)).cast("bigint")
    depleted = F.col("n_words") - taken < F.lit(left) * F.col("n_words")
    return table.drop("lines").join(gone, "row", "left").withColumn("removed_words", taken).withColumn(
        "kept", ~F.col("base_failed") & ~depleted
    )


def measured(docs: DataFrame) -> DataFrame:
    """Stored features: the two passes of ``judged`` read a table without texts."""
    return stored(features(docs), "quality-features")


def cleaned(docs: DataFrame, **limits) -> DataFrame:
    """The kept documents without their boilerplate lines; ``n_chars`` follows the text, other columns are kept."""
    verdict = judged(measured(docs), **limits).filter("kept").groupBy("doc_id", "text_hash", "host").agg(
        F.first("removed").alias("removed")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    normal = lambda line: F.lower(F.regexp_replace(F.btrim(line, F.lit(SPACES)), SPACE_RUN, " "))
    keyed = docs.withColumns({"__text_hash": F.xxhash64(text), "__host": host(F.col("source"))})
    v = verdict.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("host").alias("__of"), F.col("removed").alias("__removed"))
    same = (
        F.col("doc_id").cast("bigint").eqNullSafe(F.col("__doc")) & (F.col("__text_hash") == F.col("__hash"))
        & (F.col("__host") == F.col("__of"))
    )
    out = F.array_join(F.filter(F.split(text, "\n"), lambda line: ~(
        line.rlike(WORD) & F.array_contains(F.col("__removed"), F.xxhash64(normal(line)))
    )), "\n")
    joined = keyed.join(v, same).withColumn("text", F.when(F.col("__removed").isNull(), F.col("text")).otherwise(out))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast("bigint"))
    return joined.select(*docs.columns)
