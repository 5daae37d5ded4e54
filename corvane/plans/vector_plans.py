"""Distance, clustering and bag-of-words queries over ``embeddings``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import vectors
from corvane.operators import bow, lloyd, sampled_kmeans
from corvane.operators.nearest import assign_by_expression, assign_clusters
from corvane.plans.registry import load, plan
from corvane.session import scratch_path
from corvane.sources import models, text_io

K = 10
CODEWORDS = 16
# Passes over all points and batches of a pass for the mini-batch queries.
PASSES, BATCHES = 3, 4
IMAGE_CLUSTERS = 4
# Consecutive descriptors that belong to one image.
IMAGE_ROWS = 25

# ---------------------------------------------------------------- shared SQL

POINTS_SQL = "points AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings)"


def rounded(x: str) -> str:
    """Six places, without a negative zero."""
    return f"CASE WHEN round({x}, 6) = 0 THEN 0.0 ELSE CAST(round({x}, 6) AS DOUBLE) END"


def round6(x):
    out = F.round(x, 6)
    return F.when(out == 0, F.lit(0.0)).otherwise(out)


D2_SQL = "list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.m[i]) * (p.x[i] - c.m[i])))"


def seeds_sql(k: int, name: str = "c0") -> str:
    return (
        f"{name} AS (SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS cid, x AS m "
        f"FROM (SELECT id, x FROM points ORDER BY id LIMIT {k}))"
    )


def assign_sql(name: str, centres: str, points: str = "points") -> str:
    """CTE ``name``: (id, cid, d2), the lowest cid wins a tie."""
    return (
        f"{name} AS (SELECT id, cid, d2 FROM (SELECT id, cid, d2, "
        f"row_number() OVER (PARTITION BY id ORDER BY d2, cid) AS r FROM "
        f"(SELECT p.id, c.cid, {D2_SQL} AS d2 FROM {points} p, {centres} c)) WHERE r = 1)"
    )


def means_sql(name: str, assigned: str, old: str, points: str = "points") -> str:
    """CTE ``name``: new centres (cid, m); an empty cluster keeps its old one."""
    return (
        f"{name} AS (SELECT o.cid, coalesce(n.m, o.m) AS m FROM {old} o LEFT JOIN "
        f"(SELECT cid, list(v ORDER BY pos) AS m FROM (SELECT a.cid, u.pos, avg(u.v) AS v FROM {assigned} a "
        f"JOIN (SELECT id, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM {points}) u ON u.id = a.id "
        f"GROUP BY a.cid, u.pos) GROUP BY cid) n ON n.cid = o.cid)"
    )


def lloyd_sql(steps: int, k: int, points: str = "points", first: str | None = None) -> str:
    """CTEs c0, a1, c1, a2, c2, ...: seeds, memberships and centres by step."""
    parts = [first or seeds_sql(k)]
    for s in range(1, steps + 1):
        parts.append(assign_sql(f"a{s}", f"c{s - 1}", points))
        parts.append(means_sql(f"c{s}", f"a{s}", f"c{s - 1}", points))
    return ", ".join(parts)


NEAREST_SQL = f"WITH {POINTS_SQL}, {seeds_sql(K)}, {assign_sql('a1', 'c0')}"


# ------------------------------------------------------------ shared sources

def points(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, x)`` as stored: float vectors, half the size of double ones."""
    return lloyd.as_points(load(spark, folder, "embeddings"), "vec_id", "embedding")


def double_points(spark: SparkSession, folder: str) -> DataFrame:
    return points(spark, folder).withColumn("x", vectors.doubles(F.col("x")))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    table = load(spark, folder, "embeddings")
    return table.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), "label"
    )


def seeds(spark: SparkSession, folder: str, k: int = K) -> np.ndarray:
    return lloyd.seed_centers(points(spark, folder), k)


# ------------------------------------------------------------ vector scalars

@plan(
    "sq_distance",
    f"WITH {POINTS_SQL}, {seeds_sql(K)} SELECT p.id, c.cid, {rounded(D2_SQL)} AS d2 FROM points p, c0 c",
)
def sq_distance(spark, folder):
    """Every point against all seeds, from one literal seed table."""
    table = vectors.vector_table_literal(seeds(spark, folder))
    each = F.posexplode(F.transform(table, lambda m: vectors.sq_distance(F.col("x"), m)))
    rows = double_points(spark, folder).select("id", each.alias("cid", "d2"))
    return rows.select("id", "cid", round6(F.col("d2")).alias("d2"))


@plan(
    "euclid_distance",
    f"WITH {POINTS_SQL}, {seeds_sql(K)} SELECT p.id, c.cid, {rounded(f'sqrt({D2_SQL})')} AS d "
    "FROM points p, c0 c",
)
def euclid_distance(spark, folder):
    table = vectors.vector_table_literal(seeds(spark, folder))
    each = F.posexplode(F.transform(table, lambda m: vectors.distance(F.col("x"), m)))
    rows = double_points(spark, folder).select("id", each.alias("cid", "d"))
    return rows.select("id", "cid", round6(F.col("d")).alias("d"))


SCALED_SQL = "list_transform(x, lambda v: v * label)"


@plan(
    "l2_normalize",
    f"WITH {POINTS_SQL}, scaled AS (SELECT id, {SCALED_SQL} AS y FROM points), "
    "normed AS (SELECT id, y, nullif(sqrt(list_sum(list_transform(y, lambda v: v * v))), 0) AS n FROM scaled) "
    f"SELECT id, pos, {rounded('v / n')} AS v FROM (SELECT id, n, unnest(y) AS v, "
    "CAST(generate_subscripts(y, 1) - 1 AS INTEGER) AS pos FROM normed)",
)
def l2_normalize(spark, folder):
    """Vectors scaled by their label, so that label 0 gives zero vectors."""
    table = labelled(spark, folder)
    scaled = F.transform("x", lambda v: v * F.col("label"))
    rows = table.select("id", F.posexplode(vectors.l2_normalize(scaled)).alias("pos", "v"))
    return rows.select("id", "pos", round6(F.col("v")).alias("v"))


@plan("nearest_center", f"{NEAREST_SQL} SELECT id, cid, {rounded('d2')} AS d2 FROM a1")
def nearest_center(spark, folder):
    best = assign_by_expression(points(spark, folder), seeds(spark, folder))
    return best.select("id", "cid", round6(F.col("d2")).alias("d2"))


SCORES_SQL = (
    f"WITH {POINTS_SQL}, {seeds_sql(K)}, scored AS (SELECT p.id, c.cid, exp(-{D2_SQL}) AS e FROM points p, c0 c), "
    "probs AS (SELECT id, cid, e / sum(e) OVER (PARTITION BY id) AS p FROM scored), "
    "ranked AS (SELECT id, cid, p, row_number() OVER (PARTITION BY id ORDER BY p DESC, cid) AS r FROM probs)"
)


def seed_scores(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, p)``: softmax over the negative squared distances to the seeds."""
    table = vectors.vector_table_literal(seeds(spark, folder))
    scores = F.transform(table, lambda m: -vectors.sq_distance(F.col("x"), m))
    # Two projections, so that the distances are worked out once per point.
    return double_points(spark, folder).select("id", scores.alias("s")).select(
        "id", vectors.softmax(F.col("s")).alias("p")
    )


@plan("softmax", f"{SCORES_SQL} SELECT id, cid, {rounded('p')} AS p FROM probs")
def softmax(spark, folder):
    rows = seed_scores(spark, folder).select("id", F.posexplode("p").alias("cid", "p"))
    return rows.select("id", "cid", round6(F.col("p")).alias("p"))


@plan("top1_class", f"{SCORES_SQL} SELECT id, cid AS cls, {rounded('p')} AS confidence FROM ranked WHERE r = 1")
def top1_class(spark, folder):
    best = seed_scores(spark, folder).select("id", vectors.top_class(F.col("p")).alias("best"))
    return best.select("id", F.col("best.cls").alias("cls"), round6(F.col("best.score")).alias("confidence"))


@plan(
    "class_ranking",
    f"{SCORES_SQL} SELECT id, CAST(r AS INTEGER) AS rank, cid AS cls, {rounded('p')} AS confidence FROM ranked",
)
def class_ranking(spark, folder):
    rows = seed_scores(spark, folder).select(
        "id", F.posexplode(vectors.class_ranking(F.col("p"))).alias("at", "s")
    )
    return rows.select(
        "id", (F.col("at") + 1).alias("rank"), F.col("s.cls").alias("cls"), round6(F.col("s.score")).alias("confidence")
    )


# ---------------------------------------------------------------- clustering

@plan(
    "seed_centers",
    f"WITH {POINTS_SQL} SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS cid, id "
    f"FROM (SELECT id FROM points ORDER BY id LIMIT {K})",
)
def seed_centers(spark, folder):
    return lloyd.seed_rows(points(spark, folder), K).select("cid", "id")


@plan("assign_clusters", f"{NEAREST_SQL} SELECT id, cid FROM a1")
def assign(spark, folder):
    return assign_clusters(points(spark, folder), seeds(spark, folder)).select("id", "cid")


@plan("cluster_sizes", f"{NEAREST_SQL} SELECT cid, count(*) AS n FROM a1 GROUP BY cid")
def cluster_sizes(spark, folder):
    assigned = assign_clusters(points(spark, folder), seeds(spark, folder))
    return assigned.groupBy("cid").agg(F.count(F.lit(1)).alias("n"))


@plan(
    "cluster_sums",
    f"{NEAREST_SQL} SELECT cid, pos, count(*) AS n, {rounded('sum(v)')} AS total FROM "
    "(SELECT a1.cid, unnest(x) AS v, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS pos "
    "FROM a1 JOIN points USING (id)) GROUP BY cid, pos",
)
def cluster_sums(spark, folder):
    totals = lloyd.cluster_totals(points(spark, folder), seeds(spark, folder))
    return totals.select("cid", "pos", "n", round6(F.col("total")).alias("total"))


LLOYD_SQL = f"WITH {POINTS_SQL}, {lloyd_sql(3, K)}"
CENTRE_CELLS_SQL = (
    "SELECT cid, pos, {v} AS value FROM (SELECT cid, unnest(m) AS v, "
    "CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS pos FROM {c})"
)


@plan(
    "lloyd_step",
    f"WITH {POINTS_SQL}, {lloyd_sql(1, K)} " + CENTRE_CELLS_SQL.format(v=rounded("v"), c="c1"),
)
def lloyd_step(spark, folder):
    step = lloyd.step_rows(points(spark, folder), seeds(spark, folder))
    return step.select("cid", "pos", round6(F.col("value")).alias("value"))


@plan(
    "membership_delta",
    f"WITH {POINTS_SQL}, {lloyd_sql(2, K)} SELECT CAST(sum(CASE WHEN a1.cid <> a2.cid THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS changed, {rounded('avg(CASE WHEN a1.cid <> a2.cid THEN 1.0 ELSE 0.0 END)')} AS delta "
    "FROM a1 JOIN a2 ON a1.id = a2.id",
)
def membership_delta(spark, folder):
    table, first = points(spark, folder), seeds(spark, folder)
    second, _, _ = lloyd.step_arrays(table, first, None)
    moved = lloyd.membership_delta(assign_clusters(table, first), assign_clusters(table, second))
    return moved.select("changed", round6(F.col("delta")).alias("delta"))


def lloyd_steps(spark: SparkSession, folder: str, steps: int = 3, k: int = K) -> lloyd.Clustering:
    """A fixed number of steps: no membership change is below the threshold."""
    return lloyd.lloyd(points(spark, folder), k, threshold=-1.0, max_steps=steps)


@plan("lloyd_fixed_3", f"{LLOYD_SQL} " + CENTRE_CELLS_SQL.format(v=rounded("v"), c="c3"))
def lloyd_fixed_3(spark, folder):
    rows = lloyd_steps(spark, folder).centres.select("cid", F.posexplode("m").alias("pos", "v"))
    return rows.select("cid", "pos", round6(F.col("v")).alias("value"))


@plan("lloyd_membership_3", f"{LLOYD_SQL} SELECT id, cid FROM a3")
def lloyd_membership_3(spark, folder):
    return lloyd_steps(spark, folder).membership


@plan(
    "lloyd_trace",
    f"{LLOYD_SQL}, moves AS (SELECT 1 AS step, count(*) AS changed, count(*) AS n FROM a1 UNION ALL "
    "SELECT 2, count(*) FILTER (WHERE a1.cid <> a2.cid), count(*) FROM a1 JOIN a2 ON a1.id = a2.id UNION ALL "
    "SELECT 3, count(*) FILTER (WHERE a2.cid <> a3.cid), count(*) FROM a2 JOIN a3 ON a2.id = a3.id) "
    f"SELECT step, changed, {rounded('changed / n')} AS delta FROM moves",
)
def lloyd_trace(spark, folder):
    trace = lloyd_steps(spark, folder).trace
    return trace.select("step", "changed", round6(F.col("delta")).alias("delta"))


@plan("lloyd_converged")
def lloyd_converged(spark, folder):
    return lloyd.lloyd(points(spark, folder), K).membership


@plan(
    "centers_text",
    f"WITH {POINTS_SQL}, {seeds_sql(K)} SELECT cid || ' ' || array_to_string("
    "list_transform(m, lambda v: printf('%.6f', v)), ' ') AS line FROM c0",
)
def centers_text(spark, folder):
    centres = lloyd.seed_rows(points(spark, folder), K)
    return centres.select(text_io.centre_text(F.col("cid"), F.col("m")).alias("line"))


@plan("membership_text", f"{NEAREST_SQL} SELECT id || ' ' || cid AS line FROM a1")
def membership_text(spark, folder):
    assigned = assign_clusters(points(spark, folder), seeds(spark, folder))
    return assigned.select(text_io.membership_text(F.col("id"), F.col("cid")).alias("line"))


@plan(
    "images_by_cluster",
    f"{NEAREST_SQL} SELECT cid AS prediction, 'image-' || id AS key FROM a1",
)
def images_by_cluster(spark, folder):
    key = F.concat(F.lit("image-"), F.col("id").cast("string")).alias("key")
    return sampled_kmeans.images_by_cluster(points(spark, folder).select(key, "x"), seeds(spark, folder))


@plan("kmeans_ml")
def kmeans_ml(spark, folder):
    table = points(spark, folder)
    model = sampled_kmeans.kmeans_ml(table, K, 20)
    keyed = table.select(F.col("id").alias("key"), "x")
    return sampled_kmeans.images_by_cluster(keyed, np.array(model.clusterCenters()))


@plan("kmeans_ml_centers")
def kmeans_ml_centers(spark, folder):
    table = points(spark, folder)
    return sampled_kmeans.ml_centres(table, sampled_kmeans.kmeans_ml(table, K, 20))


@plan("minibatch_kmeans")
def minibatch_kmeans(spark, folder):
    table = points(spark, folder)
    found = sampled_kmeans.minibatch_kmeans(table, K, PASSES, BATCHES)
    return assign_clusters(table, found.centres).select("id", "cid")


@plan(
    "minibatch_coverage",
    f"SELECT count(*) AS points, CAST({PASSES} AS INTEGER) AS passes, {PASSES} * count(*) AS seen, true AS cost_not_above_seeds "
    "FROM embeddings WHERE embedding IS NOT NULL",
)
def minibatch_coverage(spark, folder):
    """Every point is used in every pass, and the centres are no worse than their seeds."""
    table = points(spark, folder)
    start = sampled_kmeans.minibatch_kmeans(table, K, 0, BATCHES).centres
    found = sampled_kmeans.minibatch_kmeans(table, K, PASSES, BATCHES)
    measured = assign_clusters(assign_clusters(table, start, name="first", keep_vector=True), found.centres, name="last")
    both = measured.agg(F.sum("first_d2").alias("before"), F.sum("last_d2").alias("after"))
    return both.select(
        F.lit(found.points).cast("bigint").alias("points"), F.lit(PASSES).alias("passes"),
        F.lit(found.seen).cast("bigint").alias("seen"), (F.col("after") <= F.col("before")).alias("cost_not_above_seeds"),
    )


@plan("codebook")
def codebook(spark, folder):
    table = points(spark, folder)
    return lloyd.centre_rows(spark, sampled_kmeans.minibatch_kmeans(table, CODEWORDS, PASSES, BATCHES).centres)


# ------------------------------------------------------------- bag of words

WORDS_SQL = (
    f"WITH {POINTS_SQL}, {seeds_sql(CODEWORDS)}, {assign_sql('a1', 'c0')}, "
    f"words AS (SELECT CAST(floor(id / {IMAGE_ROWS}) AS BIGINT) AS image_id, id AS descriptor_id, cid AS word FROM a1), "
    "bins AS (SELECT i.image_id, w.cid AS word, count(words.word) AS n FROM "
    "(SELECT DISTINCT image_id FROM words) i CROSS JOIN c0 w "
    "LEFT JOIN words ON words.image_id = i.image_id AND words.word = w.cid GROUP BY i.image_id, w.cid), "
    "features AS (SELECT image_id, word, n / sqrt(sum(n * n) OVER (PARTITION BY image_id)) AS weight FROM bins)"
)


def descriptors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as descriptors; consecutive ids belong to one image."""
    image = F.expr(f"id div {IMAGE_ROWS}").alias("image_id")
    return points(spark, folder).select(image, F.col("id").alias("descriptor_id"), "x")


def quantized(spark: SparkSession, folder: str) -> DataFrame:
    return bow.quantize(descriptors(spark, folder), seeds(spark, folder, CODEWORDS))


@plan("quantize", f"{WORDS_SQL} SELECT image_id, descriptor_id, word FROM words")
def quantize(spark, folder):
    return quantized(spark, folder)


@plan("codebook_reused", f"{WORDS_SQL} SELECT image_id, descriptor_id, word FROM words")
def codebook_reused(spark, folder):
    """One job keeps a codebook, another reads it and looks descriptors up in it."""
    path = scratch_path(spark, "codebook")
    models.save_vectors(lloyd.centre_rows(spark, seeds(spark, folder, CODEWORDS)), path)
    kept = sorted(models.load_vectors(spark, path).select("cid", "m").collect())
    return bow.quantize(descriptors(spark, folder), np.array([m for _, m in kept]))


@plan("bow_histogram", f"{WORDS_SQL} SELECT image_id, word, n FROM bins")
def bow_histogram(spark, folder):
    hist = bow.bow_histogram(quantized(spark, folder), CODEWORDS)
    return hist.select("image_id", F.posexplode("counts").alias("word", "n"))


@plan("bow_feature", f"{WORDS_SQL} SELECT image_id, word, {rounded('weight')} AS weight FROM features")
def bow_feature(spark, folder):
    features = bow.bow_feature(quantized(spark, folder), CODEWORDS)
    rows = features.select("image_id", F.posexplode("feature").alias("word", "weight"))
    return rows.select("image_id", "word", round6(F.col("weight")).alias("weight"))


@plan(
    "bow_emit",
    f"{WORDS_SQL} SELECT '{bow.RECORD_TAG}' AS tag, p.url, f.feature FROM pages p LEFT JOIN "
    "(SELECT image_id, '[' || string_agg(printf('%.6f', weight), ', ' ORDER BY word) || ']' AS feature "
    "FROM features GROUP BY image_id) f ON f.image_id = p.page_id",
)
def bow_emit(spark, folder):
    images = load(spark, folder, "pages").select(F.col("page_id").alias("image_id"), "url")
    return bow.bow_rows(images, bow.bow_feature(quantized(spark, folder), CODEWORDS))


IMAGE_POINTS_SQL = (
    "images AS (SELECT image_id AS id, list(weight ORDER BY word) AS x FROM features GROUP BY image_id), "
    "s0 AS (SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS cid, x AS m "
    f"FROM (SELECT id, x FROM images ORDER BY id LIMIT {IMAGE_CLUSTERS}))"
)


@plan(
    "image_clusters",
    f"{WORDS_SQL}, {IMAGE_POINTS_SQL}, {assign_sql('b1', 's0', 'images')}, {means_sql('s1', 'b1', 's0', 'images')}, "
    f"{assign_sql('b2', 's1', 'images')} SELECT id AS image_id, cid FROM b2",
)
def image_clusters(spark, folder):
    """Descriptors -> features -> two Lloyd steps -> cluster of each image."""
    features = bow.bow_feature(quantized(spark, folder), CODEWORDS)
    table = lloyd.as_points(features, "image_id", "feature")
    result = lloyd.lloyd(table, IMAGE_CLUSTERS, threshold=-1.0, max_steps=2)
    return result.membership.withColumnRenamed("id", "image_id")
