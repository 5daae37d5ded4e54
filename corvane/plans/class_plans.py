"""Label, standardising, scoring and evaluation queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import labels
from corvane.operators import classify, lloyd, ranking
from corvane.operators.nearest import assign_clusters
from corvane.plans.registry import load, plan
from corvane.plans.vector_plans import K, NEAREST_SQL, POINTS_SQL, double_points, labelled, points, round6, rounded, seeds
from corvane.session import scratch_path
from corvane.sources import models

FOLDER = "images/classification/"
TRAIN_ITERATIONS = 15

_NAMES = ", ".join(f"'{n}'" for n in labels.BUILDING_CLASSES)
PATHS_SQL = (
    "paths AS (SELECT p_partkey, "
    f"'{FOLDER}' || ([{_NAMES}])[p_size % {len(labels.BUILDING_CLASSES)} + 1] || '_' || p_partkey || '.jpg' AS path "
    "FROM part)"
)
PREFIX_SQL = (
    "CASE substr(parse_filename(path), 1, 2) "
    + " ".join(f"WHEN '{p}' THEN {n}" for p, n in labels.PREFIX_LABELS.items())
    + " END"
)
OBJECTS_SQL = "classes(label, name) AS (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, n in enumerate(labels.OBJECT_CLASSES, 1)
) + ")"
BUILDINGS_SQL = "classes(label, name) AS (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, n in enumerate(labels.BUILDING_CLASSES, 1)
) + ")"


# -------------------------------------------------------------------- labels

def image_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Image paths spelt from ``part``: class name, key and extension."""
    size = F.col("p_size") % len(labels.BUILDING_CLASSES) + 1
    name = labels.class_name(size, labels.BUILDING_CLASSES)
    path = F.concat(F.lit(FOLDER), name, F.lit("_"), F.col("p_partkey").cast("string"), F.lit(".jpg"))
    return load(spark, folder, "part").select("p_partkey", path.alias("path"))


@plan("label_from_prefix", f"WITH {PATHS_SQL} SELECT p_partkey, path, {PREFIX_SQL} AS label FROM paths")
def label_from_prefix(spark, folder):
    paths = image_paths(spark, folder)
    return paths.select("p_partkey", "path", labels.label_from_prefix(F.col("path")).alias("label"))


@plan(
    "label_from_suffix",
    "SELECT p_partkey, CAST(p_size % 5 + 1 AS INTEGER) AS label FROM part",
)
def label_from_suffix(spark, folder):
    digit = (F.col("p_size") % 5 + 1).cast("string")
    name = F.concat("p_name", F.lit("|"), digit, F.lit("d.jpg"))
    return load(spark, folder, "part").select("p_partkey", labels.label_from_suffix(name).alias("label"))


@plan(
    "class_names",
    f"WITH {OBJECTS_SQL} SELECT vec_id AS id, c.name FROM embeddings e JOIN classes c ON c.label = e.label + 1",
)
def class_names(spark, folder):
    # The class list is a constant of a few names.
    classes = F.broadcast(labels.class_table(spark, labels.OBJECT_CLASSES))
    rows = labelled(spark, folder).select("id", (F.col("label") + 1).alias("label"))
    return rows.join(classes, "label").select("id", "name")


@plan(
    "label_counts",
    f"WITH {PATHS_SQL}, {BUILDINGS_SQL}, labelled AS (SELECT {PREFIX_SQL} AS label FROM paths) "
    "SELECT c.label, c.name, count(l.label) AS items FROM classes c LEFT JOIN labelled l ON l.label = c.label "
    "GROUP BY c.label, c.name",
)
def label_counts(spark, folder):
    rows = image_paths(spark, folder).select(labels.label_from_prefix(F.col("path")).alias("label"))
    return classify.label_counts(rows, labels.class_table(spark, labels.BUILDING_CLASSES))


@plan(
    "row_slice",
    f"WITH {POINTS_SQL}, ends AS (SELECT (max(id) + 1) // 4 AS a, (max(id) + 1) // 2 AS b FROM points) "
    f"SELECT id, {rounded('x[2]')} AS v FROM points, ends WHERE id BETWEEN a AND b",
)
def row_slice(spark, folder):
    """One coordinate of the second quarter of all rows, both ends included."""
    table = double_points(spark, folder)
    first = table.agg(F.expr("(max(id) + 1) div 4")).scalar()
    last = table.agg(F.expr("(max(id) + 1) div 2")).scalar()
    rows = table.filter((F.col("id") >= first) & (F.col("id") <= last))
    return rows.select("id", round6(F.col("x")[1]).alias("v"))


# -------------------------------------------------------------- standardising

CELLS_SQL = (
    "cells AS (SELECT id, id % 5 = 0 AS held_out, unnest(x) AS v, "
    "CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS pos FROM points)"
)


@plan(
    "channel_stats",
    f"WITH {POINTS_SQL}, {CELLS_SQL} SELECT pos, {rounded('avg(v)')} AS mean, {rounded('stddev_samp(v)')} AS std "
    "FROM cells GROUP BY pos",
)
def channel_stats(spark, folder):
    stats = classify.channel_stats(points(spark, folder))
    return stats.select("pos", round6(F.col("mean")).alias("mean"), round6(F.col("std")).alias("std"))


def _scaled_rows(table: DataFrame, *keep: str) -> DataFrame:
    rows = table.select("id", *keep, F.posexplode("x").alias("pos", "v"))
    return rows.select("id", *keep, "pos", round6(F.col("v")).alias("v"))


@plan(
    "standardize",
    f"WITH {POINTS_SQL}, {CELLS_SQL}, stats AS (SELECT pos, avg(v) AS m, stddev_samp(v) AS s FROM cells GROUP BY pos) "
    f"SELECT id, pos, {rounded('(v - m) / s')} AS v FROM cells JOIN stats USING (pos)",
)
def standardize(spark, folder):
    table = points(spark, folder)
    return _scaled_rows(classify.standardize(table, classify.fit_scaler(table)))


@plan(
    "standardize_holdout",
    f"WITH {POINTS_SQL}, {CELLS_SQL}, stats AS (SELECT pos, avg(v) AS m, stddev_samp(v) AS s FROM cells "
    "WHERE NOT held_out GROUP BY pos) "
    f"SELECT id, held_out, pos, {rounded('(v - m) / s')} AS v FROM cells JOIN stats USING (pos)",
)
def standardize_holdout(spark, folder):
    """Statistics of the training rows, applied to all rows of both parts."""
    table = points(spark, folder).withColumn("held_out", F.col("id") % 5 == 0)
    scaler = classify.fit_scaler(table.filter(~F.col("held_out")))
    return _scaled_rows(classify.standardize(table, scaler), "held_out")


# ----------------------------------------------------------------- evaluation

JUDGED_SQL = (
    f"{NEAREST_SQL}, seed_labels AS (SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS cid, label AS pred "
    f"FROM (SELECT id, label FROM points ORDER BY id LIMIT {K})), "
    "judged AS (SELECT p.id, p.label + 1 AS label, s.pred + 1 AS pred FROM points p "
    "JOIN a1 ON a1.id = p.id JOIN seed_labels s ON s.cid = a1.cid)"
)


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, label, pred)``, from 1: the prediction is the label of the nearest seed."""
    table = labelled(spark, folder)
    assigned = assign_clusters(table, seeds(spark, folder)).select("id", "label", "cid")
    own = lloyd.seed_rows(points(spark, folder), K).select("cid", "id")
    # Limited to K rows, so broadcast to the table.
    truth = table.select("id", F.col("label").alias("pred"))
    seed_labels = truth.join(F.broadcast(own), "id").select("cid", "pred")
    rows = classify.label_by_seed(assigned, seed_labels)
    return rows.select("id", (F.col("label") + 1).alias("label"), (F.col("pred") + 1).alias("pred"))


@plan(
    "accuracy",
    f"{JUDGED_SQL} SELECT CAST(sum(CASE WHEN label = pred THEN 1 ELSE 0 END) AS BIGINT) AS correct, "
    f"count(*) AS total, {rounded('avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM judged",
)
def accuracy(spark, folder):
    result = classify.accuracy(judged(spark, folder))
    return result.withColumn("accuracy", round6(F.col("accuracy")))


@plan(
    "per_class_accuracy",
    f"{JUDGED_SQL}, {OBJECTS_SQL} SELECT c.label, c.name, "
    "CAST(coalesce(sum(CASE WHEN j.label = j.pred THEN 1 ELSE 0 END), 0) AS BIGINT) AS correct, "
    "count(j.label) AS total, "
    f"{rounded('avg(CASE WHEN j.label IS NULL THEN NULL WHEN j.label = j.pred THEN 1.0 ELSE 0.0 END)')} AS accuracy "
    "FROM classes c LEFT JOIN judged j ON j.label = c.label GROUP BY c.label, c.name",
)
def per_class_accuracy(spark, folder):
    classes = labels.class_table(spark, labels.OBJECT_CLASSES)
    result = classify.per_class_accuracy(judged(spark, folder), classes)
    return result.withColumn("accuracy", round6(F.col("accuracy")))


@plan(
    "predictions_ranked",
    f"{JUDGED_SQL} SELECT id, pred, row_number() OVER (ORDER BY pred DESC, id) AS rank FROM judged",
)
def predictions_ranked(spark, folder):
    rows = judged(spark, folder).select("id", "pred")
    return ranking.global_rank(rows, [F.col("pred").desc(), F.col("id")])


# ------------------------------------------------------------------- training

HELD_OUT = 5


def _trained(spark: SparkSession, folder: str):
    """Trained on four fifths of the ids; every fifth id is kept for judging."""
    return classify.train_classifier(
        labelled(spark, folder).filter(F.col("id") % HELD_OUT != 0), len(labels.OBJECT_CLASSES), max_iter=TRAIN_ITERATIONS
    )


@plan("train_classifier")
def train_classifier(spark, folder):
    """Accuracy of the trained network on the rows it has not seen."""
    table = labelled(spark, folder).filter(F.col("id") % HELD_OUT == 0)
    scored = classify.score_batch(_trained(spark, folder), table, labels.OBJECT_CLASSES)
    met = scored.select("id", F.col("cls").alias("pred")).join(
        table.select("id", (F.col("label") + 1).alias("label")), "id"
    )
    return classify.accuracy(met)


@plan("score_batch")
def score_batch(spark, folder):
    return classify.score_batch(_trained(spark, folder), points(spark, folder), labels.OBJECT_CLASSES)


@plan("embed_penultimate")
def embed_penultimate(spark, folder):
    return classify.embed_penultimate(_trained(spark, folder), points(spark, folder))


# A small network whose weights follow a formula: 64 inputs, two sigmoid layers.
FORWARD_LAYERS = (5, 3)


def _weight(i: int, h: int) -> float:
    return ((i * 7 + h * 3) % 11 - 5) / 10


def _layer_sql(source: str, n: int) -> str:
    return (
        f"list_transform(range(0, {n}), lambda h: 1 / (1 + exp(-((h % 3 - 1) / 10e0 + list_sum(list_transform("
        f"range(0, len({source})), lambda i: CAST({source}[i + 1] AS DOUBLE) * (((i * 7 + h * 3) % 11 - 5) / 10e0)))))))"
    )


@plan(
    "network_forward",
    f"WITH one AS (SELECT vec_id AS id, {_layer_sql('embedding', FORWARD_LAYERS[0])} AS a FROM embeddings WHERE embedding IS NOT NULL), "
    f"two AS (SELECT id, {_layer_sql('a', FORWARD_LAYERS[1])} AS a FROM one) "
    f"SELECT id, CAST(k - 1 AS INTEGER) AS pos, {rounded('v')} AS value "
    "FROM (SELECT id, unnest(a) AS v, generate_subscripts(a, 1) AS k FROM two)",
)
def network_forward(spark, folder):
    """The forward pass of the network, with weights that SQL can state."""
    table, layers = points(spark, folder), []
    width = len(table.select("x").head()[0])
    for n in FORWARD_LAYERS:
        matrix = np.array([[_weight(i, h) for h in range(n)] for i in range(width)])
        layers.append((matrix, np.array([(h % 3 - 1) / 10 for h in range(n)])))
        width = n
    out = classify.forward(table, layers)
    return out.select("id", F.posexplode("embedding").alias("pos", "v")).select("id", "pos", round6(F.col("v")).alias("value"))


@plan(
    "model_roundtrip",
    f"SELECT count(*) AS points, CAST(0 AS BIGINT) AS other_class, CAST(0 AS DOUBLE) AS confidence_gap FROM (SELECT vec_id FROM embeddings WHERE embedding IS NOT NULL)",
)
def model_roundtrip(spark, folder):
    """Scores before and after a model was saved and loaded: rows compared, and how far they differ."""
    path = scratch_path(spark, "model")
    model = _trained(spark, folder)
    models.save_model(model, path)
    before = classify.score_batch(model, points(spark, folder), labels.OBJECT_CLASSES)
    after = classify.score_batch(models.load_model(path), points(spark, folder), labels.OBJECT_CLASSES).select(
        "id", F.col("cls").alias("cls2"), F.col("confidence").alias("confidence2")
    )
    return before.join(after, "id").agg(
        F.count(F.lit(1)).alias("points"),
        F.sum((F.col("cls") != F.col("cls2")).cast("bigint")).alias("other_class"),
        F.max(F.abs(F.col("confidence") - F.col("confidence2"))).alias("confidence_gap"),
    )
