"""N-gram counts over lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import text


def line_table(docs: DataFrame, keep: list[str], body: str = "text") -> DataFrame:
    """One row per line: the kept columns, ``line_no`` from 1, ``line``."""
    return docs.select(
        *keep, F.posexplode(text.text_lines(F.col(body))).alias("at", "line")
    ).select(*keep, (F.col("at") + 1).cast("bigint").alias("line_no"), "line")


def token_table(lines: DataFrame, colons: bool = True) -> DataFrame:
    """Adds ``tokens``, the normalised token array of ``line``."""
    return lines.withColumn("tokens", text.tokenize(F.col("line"), colons))


def ngram_count(lines: DataFrame, n: int) -> DataFrame:
    """``(gram, cnt)`` over all lines; grams never cross a line end."""
    tokens = token_table(lines).select("tokens")
    grams = tokens.select(F.explode(text.ngrams(F.col("tokens"), n)).alias("gram"))
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("cnt"))


def token_rows(tokens: DataFrame, keep: list[str]) -> DataFrame:
    """One row per token: the kept columns, ``token_no`` from 1, ``token``."""
    # A one-token window rather than the bare column: an exploded plain column
    # gets an inferred filter that repeats the normaliser.
    rows = F.posexplode(text.ngrams(F.col("tokens"), 1)).alias("at", "token")
    return tokens.select(*keep, rows).select(*keep, (F.col("at") + 1).alias("token_no"), "token")
