"""Tag x word counts, tag vectors and tag similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import encoding, text
from corvane.operators import chunks
from corvane.operators.ngrams import token_table

# Rows a vector is written as; raise it with the vocabulary.
SEGMENTS = 16


def tag_word_count(lines: DataFrame, tag: str | None = None) -> DataFrame:
    """``(tag, word, cnt)``: per line every tag occurrence meets every word occurrence."""
    tokens = token_table(lines.select("line")).select("tokens")
    own_tags = text.tags_of(F.col("tokens"))
    if tag is not None:
        own_tags = F.filter(own_tags, lambda t: t == F.lit(tag))
    # Explode the filter expressions themselves. For a plain array column the
    # optimiser infers a size() > 0 filter and pushes it down, which runs the
    # whole normaliser a second time below the scan.
    tagged = tokens.select("tokens", F.explode(own_tags).alias("tag"))
    rows = tagged.select("tag", F.explode(text.words_of(F.col("tokens"))).alias("word"))
    return rows.groupBy("tag", "word").agg(F.count(F.lit(1)).alias("cnt"))


def encode_vectors(counts: DataFrame, key: str, feature: str, segments: int = SEGMENTS) -> DataFrame:
    """``(key, segment, vector)``: the features of a key as ``f1:c1;f2:c2`` text.

    Every key is cut into the same ``segments`` by a hash of the feature, so the
    layout never depends on the size of a key; segments without a feature have
    no row. The long form ``(key, feature, cnt)`` stays the table to compute with.
    """
    # Fixed by the text of the feature alone: every engine cuts alike.
    digest = F.conv(F.substring(F.md5(F.col(feature).cast("binary")), 1, 8), 16, 10).cast("bigint")
    cut = counts.select(
        key,
        F.pmod(digest, F.lit(segments).cast("bigint")).alias("segment"),
        F.struct(F.col(feature).alias("feature"), F.col("cnt")).alias("entry"),
    )
    return cut.groupBy(key, "segment").agg(
        encoding.encode_entries(F.collect_list("entry")).alias("vector")
    )


def decode_vectors(vectors: DataFrame, key: str, feature: str) -> DataFrame:
    """Inverse of ``encode_vectors``: ``(key, feature, cnt)``."""
    return vectors.select(
        key, F.explode(encoding.decode_vector(F.col("vector"))).alias(feature, "cnt")
    )


def tag_pair_products(counts: DataFrame, chunk_rows: int = chunks.CHUNK_ROWS) -> DataFrame:
    """``(word, a, b, product)`` for the tags of each word, ``a < b``."""
    marked = chunks.mark_by_key(counts, "word", "tag", "cnt", chunk_rows)
    pairs = chunks.unordered_pairs(marked, ["word"], "tag", "cnt")
    return pairs.select("word", "a", "b", (F.col("va") * F.col("vb")).alias("product"))


def tag_similarity(counts: DataFrame, chunk_rows: int = chunks.CHUNK_ROWS) -> DataFrame:
    """``(a, b, similarity)`` of the tags that share a word, ``a < b``."""
    products = tag_pair_products(counts, chunk_rows)
    return products.groupBy("a", "b").agg(F.sum("product").alias("similarity"))


def tag_similarity_to(counts: DataFrame, tag: str) -> DataFrame:
    """``(tag, similarity)`` of every tag with one tag, that tag included."""
    # A conditional sum instead of a filter on the tag: a filter would move below
    # the counting and read the text a second time.
    own = F.sum(F.when(F.col("tag") == tag, F.col("cnt")))
    one = counts.groupBy("word").agg(own.alias("one_cnt")).filter(F.col("one_cnt").isNotNull())
    met = chunks.salted_lookup(counts, one, "word", "tag", "inner")
    return met.groupBy("tag").agg(F.sum(F.col("cnt") * F.col("one_cnt")).alias("similarity"))
