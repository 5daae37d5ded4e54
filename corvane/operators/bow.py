"""Bag-of-words features of images from descriptor tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import vectors
from corvane.operators.nearest import assign_clusters

# Fixed value: the record tag the feature rows start with.
RECORD_TAG = "666"


def quantize(descriptors: DataFrame, codebook: np.ndarray) -> DataFrame:
    """``(image_id, descriptor_id, word)``: the nearest codeword of each descriptor."""
    keep = [c for c in descriptors.columns if c != "x"]
    return assign_clusters(descriptors, codebook, name="word").select(*keep, "word")


def bow_histogram(quantized: DataFrame, size: int) -> DataFrame:
    """``(image_id, counts)``: dense counts over ``size`` codewords.

    Counting by (image, word) first leaves at most ``size`` rows per image to
    gather, however many descriptors it has.
    """
    counted = quantized.groupBy("image_id", "word").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct(F.col("word").cast("int").alias("word"), "n")
    found = counted.groupBy("image_id").agg(F.array_sort(F.collect_list(entry)).alias("found"))
    # Each word is followed by the zeros up to the next one, the last by those up to the end.
    zeros = lambda n: F.array_repeat(F.lit(0).cast("bigint"), n)
    follows = F.concat(F.slice("found.word", 2, F.greatest(F.size("found") - 1, F.lit(0))), F.array(F.lit(size)))
    runs = F.zip_with("found", follows, lambda e, after: F.concat(F.array(e["n"]), zeros(after - e["word"] - 1)))
    dense = F.concat(zeros(F.col("found")[0]["word"]), F.flatten(runs))
    return found.select("image_id", dense.alias("counts"))


def bow_feature(quantized: DataFrame, size: int) -> DataFrame:
    """``(image_id, feature)``: the histogram divided by its Euclidean norm."""
    hist = bow_histogram(quantized, size)
    feature = vectors.l2_normalize(vectors.doubles(F.col("counts")))
    return hist.select("image_id", feature.alias("feature"))


def bow_rows(images: DataFrame, features: DataFrame) -> DataFrame:
    """``(tag, url, feature)`` for every image; null for one without descriptors."""
    listed = images.join(features, "image_id", "left")
    shown = F.concat(
        F.lit("["),
        F.concat_ws(", ", F.transform("feature", lambda v: F.format_string("%.6f", v))),
        F.lit("]"),
    )
    return listed.select(
        F.lit(RECORD_TAG).alias("tag"),
        "url",
        F.when(F.col("feature").isNotNull(), shown).alias("feature"),
    )
