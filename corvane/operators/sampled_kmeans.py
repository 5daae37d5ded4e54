"""Library k-means and mini-batch k-means for large k."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import vectors
from corvane.operators.lloyd import centre_rows, total_arrays
from corvane.operators.nearest import assign_clusters
from corvane.session import delete_path, scratch_path

# Places that a batch of a pass is drawn from, on average.
PLACES = 4


def kmeans_ml(points: DataFrame, k: int, max_iter: int, seed: int = 17):
    """k-means|| and Lloyd steps of ``pyspark.ml``; returns the fitted model."""
    # Five initial rounds are the library default of the job re-expressed here.
    learner = KMeans(k=k, maxIter=max_iter, seed=seed, initMode="k-means||", initSteps=5)
    return learner.fit(as_features(points))


def as_features(points: DataFrame) -> DataFrame:
    return points.withColumn("features", array_to_vector(vectors.doubles(F.col("x"))))


def ml_centres(points: DataFrame, model) -> DataFrame:
    return centre_rows(points.sparkSession, np.array(model.clusterCenters()))


def images_by_cluster(keyed: DataFrame, centres: np.ndarray) -> DataFrame:
    """``(prediction, key)`` for a table with a ``key`` and ``x``; centres of any clustering."""
    return assign_clusters(keyed, centres, name="prediction").select("prediction", "key")


@dataclass
class MiniBatches:
    """``centres`` (k x d), ``points`` of the table, ``seen`` points over all passes."""

    centres: np.ndarray
    points: int
    seen: int


def dealt(points: DataFrame, places: int, seed: int = 17) -> tuple[DataFrame, str]:
    """``place, id, x`` written once to the shared folder, a directory for each place, and its path.

    A place is a hash class of the ids. Its rows are spread over several tasks
    where there are more tasks than places, so no place grows beyond a task.
    """
    spark = points.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    of = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n)).cast("int")
    rows = points.select(of(seed, places).alias("place"), "id", "x")
    spread = rows.withColumn("share", of(seed + 1, -(-tasks // places))).repartition(tasks, "place", "share").drop("share")
    path = scratch_path(spark, "places")
    spread.write.partitionBy("place").parquet(path)
    schema = T.StructType([*(points.schema[c] for c in ("id", "x")), T.StructField("place", T.IntegerType())])
    return spark.read.schema(schema).parquet(path), path


def batches_of_pass(turn: int, places: int, batches: int, seed: int = 17) -> list[list[int]]:
    """The places of every batch of a pass: each place in one batch, drawn anew for each pass."""
    order = np.random.default_rng((seed, turn)).permutation(places)
    return [sorted(part.tolist()) for part in np.array_split(order, batches)]


def minibatch_kmeans(points: DataFrame, k: int, passes: int = 100, batches_per_pass: int = 16,
                     seed: int = 17) -> MiniBatches:
    """Centres moved by one batch at a time with step 1 / (points seen).

    Points are dealt once into ``PLACES`` places for each batch of a pass. A
    batch is a set of places, drawn anew for each pass, and its job opens the
    files of those places only: a pass reads every point once, whatever the
    number of batches. k x d sums come back per batch. The places are written
    to the shared folder, so a lost executor costs nothing but its tasks, and
    are deleted at the end.
    """
    draw = F.xxhash64(F.lit(seed), "id")
    first = points.orderBy(draw, "id").limit(k).collect()
    if len(first) < k:
        raise ValueError(f"k = {k} exceeds the number of points ({len(first)})")
    centres = np.array([r["x"] for r in first], dtype=np.float64)
    places = PLACES * batches_per_pass
    table, path = dealt(points, places, seed)
    seen = np.zeros(k)
    try:
        count = table.count()
        for turn in range(passes):
            for batch in batches_of_pass(turn, places, batches_per_pass, seed):
                n, _, sums = total_arrays(table.filter(F.col("place").isin(batch)), centres)
                moved = n > 0
                seen += n
                # All single 1/seen steps of a batch add up to the running mean.
                centres[moved] += (sums - n[:, None] * centres)[moved] / seen[moved, None]
    finally:
        delete_path(points.sparkSession, path)
    return MiniBatches(centres, count, int(seen.sum()))
