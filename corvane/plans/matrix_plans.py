"""Matrix products and result comparison over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators import compare, lloyd, matrix
from corvane.operators.nearest import assign_clusters
from corvane.plans.registry import load, plan
from corvane.plans.text_plans import POSTS_SQL, post_counts
from corvane.plans.vector_plans import K, POINTS_SQL, lloyd_sql, points, round6, rounded, seeds

CELLS_SQL = (
    f"{POINTS_SQL}, cells AS (SELECT id AS i, CAST(generate_subscripts(x, 1) - 1 AS BIGINT) AS j, "
    "unnest(x) AS v FROM points)"
)
# X^T . X: the inner dimension is the number of vectors.
PRODUCT_SQL = (
    f"WITH {CELLS_SQL} SELECT a.j AS i, b.j AS j, {rounded('sum(a.v * b.v)')} AS v "
    "FROM cells a JOIN cells b ON a.i = b.i GROUP BY a.j, b.j"
)


def vector_cells(spark: SparkSession, folder: str) -> DataFrame:
    return matrix.cells(points(spark, folder))


def _rounded_cells(m: DataFrame) -> DataFrame:
    return m.select("i", "j", round6(F.col("v")).alias("v"))


@plan("transpose", f"WITH {CELLS_SQL} SELECT j AS i, i AS j, {rounded('v')} AS v FROM cells")
def transpose(spark, folder):
    return _rounded_cells(matrix.transpose(vector_cells(spark, folder)))


@plan("matmul_coo", PRODUCT_SQL)
def matmul_coo(spark, folder):
    x = vector_cells(spark, folder)
    return _rounded_cells(matrix.matmul_coo(matrix.transpose(x), x))


@plan("matmul_block", PRODUCT_SQL)
def matmul_block(spark, folder):
    x = vector_cells(spark, folder)
    return _rounded_cells(matrix.matmul_block(matrix.transpose(x), x))


@plan(
    "matmul_rect",
    "WITH supplied AS (SELECT l_suppkey, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem "
    "GROUP BY l_suppkey, l_partkey) "
    "SELECT s.l_suppkey AS i, p.p_brand AS j, CAST(sum(s.q * p.p_size) AS BIGINT) AS v "
    "FROM supplied s JOIN part p ON p.p_partkey = s.l_partkey GROUP BY s.l_suppkey, p.p_brand",
)
def matmul_rect(spark, folder):
    """Supplier x part quantities times part x brand sizes."""
    supplied = load(spark, folder, "lineitem").groupBy("l_suppkey", "l_partkey").agg(
        F.sum("l_quantity").cast("bigint").alias("v")
    )
    a = supplied.select(F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j"), "v")
    b = load(spark, folder, "part").select(
        F.col("p_partkey").alias("i"), F.col("p_brand").alias("j"), F.col("p_size").cast("bigint").alias("v")
    )
    return matrix.matmul_coo(a, b)


@plan(
    "gram_matrix",
    f"WITH {POSTS_SQL} SELECT x.tag AS i, y.tag AS j, CAST(sum(x.cnt * y.cnt) AS BIGINT) AS v "
    "FROM counts x JOIN counts y ON x.word = y.word GROUP BY x.tag, y.tag",
)
def gram_matrix(spark, folder):
    """All tag dot products; above the diagonal these are the tag similarities."""
    counts = post_counts(spark, folder)
    return matrix.gram_matrix(counts.select(F.col("tag").alias("i"), F.col("word").alias("j"), F.col("cnt").alias("v")), repeated=False)


@plan(
    "max_abs_diff",
    f"WITH {CELLS_SQL} SELECT {rounded('max(abs(v - round(v, 3)))')} AS max_diff FROM cells",
)
def max_abs_diff(spark, folder):
    """Vectors against themselves cut to three places."""
    x = vector_cells(spark, folder)
    cut = x.withColumn("v", F.round("v", 3))
    return compare.max_abs_diff(x, cut).select(round6(F.col("max_diff")).alias("max_diff"))


@plan(
    "frame_diff",
    f"WITH {POINTS_SQL}, {lloyd_sql(2, K)}, gone AS (SELECT id, cid FROM a1 EXCEPT ALL SELECT id, cid FROM a2), "
    "came AS (SELECT id, cid FROM a2 EXCEPT ALL SELECT id, cid FROM a1) "
    "SELECT 'left' AS side, id, cid, count(*) AS copies FROM gone GROUP BY id, cid UNION ALL "
    "SELECT 'right', id, cid, count(*) FROM came GROUP BY id, cid",
)
def frame_diff(spark, folder):
    """Memberships before and after one Lloyd step."""
    table, first = points(spark, folder), seeds(spark, folder)
    second, _, _ = lloyd.step_arrays(table, first, None)
    before = assign_clusters(table, first).select("id", "cid")
    after = assign_clusters(table, second).select("id", "cid")
    return compare.frame_diff(before, after)
