"""Whole jobs: read inputs, run the operators, write text outputs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import vectors
from corvane.operators import bow, classify, lloyd, ngrams, sampled_kmeans, tags
from corvane.session import spread
from corvane.sources import binary_points, models, text_io


def tag_similarity_job(spark: SparkSession, inputs: list[str], output: str) -> None:
    """Lines -> ``similarity<TAB>a<TAB>b`` in ascending order."""
    lines = spread(text_io.read_lines(spark, *inputs))
    counts = tags.tag_word_count(lines)
    ordered = tags.tag_similarity(counts).orderBy("similarity", "a", "b").select("similarity", "a", "b")
    text_io.write_pairs(ordered, output)


def ngram_job(spark: SparkSession, inputs: list[str], output: str, n: int) -> None:
    """Lines -> ``gram<TAB>count``."""
    text_io.write_pairs(ngrams.ngram_count(spread(text_io.read_lines(spark, *inputs)), n), output)


def kmeans_job(spark: SparkSession, path: str, k: int, threshold: float = 0.001, binary: bool = False) -> lloyd.Clustering:
    """A points file -> ``<path>.cluster_centres`` and ``<path>.membership``."""
    if binary:
        points = binary_points.read_binary_points(spark, path)
    else:
        points = text_io.read_points(spark, path).withColumn("id", F.col("id").cast("bigint"))
    result = lloyd.lloyd(points, k, threshold)
    text_io.write_centres(result.centres, f"{path}.cluster_centres")
    text_io.write_membership(result.membership, f"{path}.membership")
    return result


def image_features_job(images: DataFrame, descriptors: DataFrame, codebook: DataFrame, output: str) -> None:
    """Images ``(image_id, url)``, descriptors and a codebook ``(cid, m)`` -> feature lines."""
    # k x d numbers, chosen by the caller; assignment slices what it sends out.
    rows = codebook.orderBy("cid").select(vectors.doubles(F.col("m")).alias("m")).collect()
    centres = np.array([r["m"] for r in rows])
    features = bow.bow_feature(bow.quantize(descriptors, centres), len(centres))
    text_io.write_pairs(bow.bow_rows(images, features), output)


def image_cluster_job(spark: SparkSession, features: str, output: str, k: int, max_iter: int, seed: int = 17) -> None:
    """Feature lines -> ``cluster<TAB>url``; images without a feature are left out."""
    lines = text_io.read_lines(spark, features)
    parsed = lines.filter(text_io.tsv_field(F.col("line"), 2) != "").select(
        text_io.tsv_field(F.col("line"), 1).alias("key"),
        text_io.bracketed_vector(text_io.tsv_field(F.col("line"), 2)).alias("x"),
    )
    model = sampled_kmeans.kmeans_ml(parsed, k, max_iter, seed)
    text_io.write_pairs(sampled_kmeans.images_by_cluster(parsed, np.array(model.clusterCenters())), output)


def classify_job(items: DataFrame, model_path: str, names: list[str], output: str) -> None:
    """Items ``(id, x)`` -> ``class<TAB>confidence<TAB>id<TAB>name``, highest class first."""
    scored = classify.score_batch(models.load_model(model_path), items, names)
    ordered = scored.orderBy(F.col("cls").desc(), "id").select("cls", "confidence", "id", "name")
    text_io.write_pairs(ordered, output)
