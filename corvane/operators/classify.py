"""Standardising, training, scoring and evaluating classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import labels, vectors
from corvane.operators.nearest import batch_matrix

HIDDEN = (120, 84)


def _features(vector: str) -> Column:
    return array_to_vector(vectors.doubles(F.col(vector)))


def channel_stats(points: DataFrame, vector: str = "x") -> DataFrame:
    """``(pos, mean, std)`` per coordinate; the deviation divides by n - 1."""
    summary = points.select(_features(vector).alias("v")).agg(
        Summarizer.metrics("mean", "std").summary(F.col("v")).alias("s")
    )
    both = summary.select(
        F.arrays_zip(
            vector_to_array("s.mean").alias("mean"), vector_to_array("s.std").alias("std")
        ).alias("rows")
    )
    return both.select(F.posexplode("rows").alias("pos", "r")).select("pos", "r.mean", "r.std")


def fit_scaler(train: DataFrame, vector: str = "x"):
    """Per-coordinate (x - mean) / std, learnt on ``train``."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return scaler.fit(train.select(_features(vector).alias("features")))


def standardize(points: DataFrame, scaler, vector: str = "x") -> DataFrame:
    """Replaces ``vector`` by its standardised form."""
    scaled = scaler.transform(points.withColumn("features", _features(vector)))
    return scaled.withColumn(vector, vector_to_array("scaled")).drop("features", "scaled")


def train_classifier(train: DataFrame, classes: int, max_iter: int = 50, seed: int = 17,
                     vector: str = "x") -> PipelineModel:
    """Scaler and a dense d-120-84-classes network over ``(x, label)``, labels from 0."""
    table = train.select(_features(vector).alias("features"), F.col("label").cast("double"))
    width = len(train.select(vector).head()[0])
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    network = MultilayerPerceptronClassifier(
        layers=[width, *HIDDEN, classes], featuresCol="scaled", maxIter=max_iter, seed=seed
    )
    return Pipeline(stages=[scaler, network]).fit(table)


def score_batch(model: PipelineModel, points: DataFrame, names: list[str], vector: str = "x") -> DataFrame:
    """``(id, cls, confidence, name)`` per row; ``cls`` counts from 1."""
    scored = model.transform(points.withColumn("features", _features(vector)))
    best = vectors.top_class(vector_to_array("probability"))
    ranked = scored.select("id", best.alias("best"))
    cls = F.col("best.cls") + 1
    return ranked.select(
        "id",
        cls.alias("cls"),
        F.col("best.score").alias("confidence"),
        labels.class_name(cls, names).alias("name"),
    )


def layer_weights(network) -> list[tuple[np.ndarray, np.ndarray]]:
    """The flat weight vector of the network as (matrix, offset) per layer."""
    flat, sizes, at, out = np.array(network.weights), network.getLayers(), 0, []
    for rows, cols in zip(sizes, sizes[1:]):
        matrix = flat[at : at + rows * cols].reshape(rows, cols)
        at += rows * cols
        out.append((matrix, flat[at : at + cols]))
        at += cols
    return out


def embed_penultimate(model: PipelineModel, points: DataFrame, vector: str = "x") -> DataFrame:
    """``(id, embedding)``: activations of the last hidden layer."""
    scaler, network = model.stages
    scaled = scaler.transform(points.select("id", _features(vector).alias("features")))
    return forward(scaled.select("id", vector_to_array("scaled").alias("x")), layer_weights(network)[:-1])


def forward(points: DataFrame, layers: list[tuple[np.ndarray, np.ndarray]], vector: str = "x") -> DataFrame:
    """``(id, embedding)``: activations after the given layers, each a matrix and an offset before a sigmoid."""
    table = points.select("id", vector)
    id_type = table.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a = batch_matrix(batch.column(1))
            for matrix, offset in layers:
                a = 1.0 / (1.0 + np.exp(-(a @ matrix + offset)))
            column = pa.array(list(a), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["id", "embedding"])

    return table.mapInArrow(run, f"id {id_type}, embedding array<double>")


def label_by_seed(assigned: DataFrame, seeds: DataFrame) -> DataFrame:
    """Adds ``pred``: the label of the nearest seed; ``seeds`` is ``(cid, pred)``, k rows."""
    # One row per centre: its number is a parameter of the assignment.
    return assigned.join(F.broadcast(seeds), "cid")


def accuracy(judged: DataFrame) -> DataFrame:
    """``(correct, total, accuracy)`` of a table with ``label`` and ``pred``."""
    hit = (F.col("label") == F.col("pred")).cast("bigint")
    return judged.agg(
        F.sum(hit).alias("correct"), F.count(F.lit(1)).alias("total"), F.avg(hit).alias("accuracy")
    )


def per_class_accuracy(judged: DataFrame, classes: DataFrame) -> DataFrame:
    """``(label, name, correct, total, accuracy)`` for every class of ``(label, name)``."""
    hit = (F.col("label") == F.col("pred")).cast("bigint")
    counted = judged.groupBy("label").agg(F.sum(hit).alias("correct"), F.count(F.lit(1)).alias("total"))
    zero = F.lit(0).cast("bigint")
    listed = classes.join(counted, "label", "left").select(
        "label", "name", F.coalesce("correct", zero).alias("correct"), F.coalesce("total", zero).alias("total")
    )
    return listed.withColumn("accuracy", F.try_divide("correct", "total"))


def label_counts(table: DataFrame, classes: DataFrame) -> DataFrame:
    """``(label, name, items)`` for every class."""
    counted = table.groupBy("label").agg(F.count(F.lit(1)).alias("items"))
    return classes.join(counted, "label", "left").select(
        "label", "name", F.coalesce("items", F.lit(0).cast("bigint")).alias("items")
    )
