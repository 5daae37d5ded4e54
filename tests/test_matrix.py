import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import compare, matrix


def coo(spark, dense):
    rows = [(i, j, float(v)) for (i, j), v in np.ndenumerate(dense) if v]
    return spark.createDataFrame(rows, "i bigint, j bigint, v double")


def dense(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r["i"], r["j"]] += r["v"]
    return out


def test_product_by_hand(spark, rows):
    a, b = coo(spark, np.array([[1, 2], [3, 4]])), coo(spark, np.array([[5, 6], [7, 8]]))
    expected = [(0, 0, 19.0), (0, 1, 22.0), (1, 0, 43.0), (1, 1, 50.0)]
    assert rows(matrix.matmul_coo(a, b), "i", "j", "v") == expected
    assert rows(matrix.matmul_block(a, b), "i", "j", "v") == expected
    assert rows(matrix.matmul(a, b), "i", "j", "v") == expected


@pytest.mark.parametrize("n", [8, 10, 32, 33])
def test_square_sizes(spark, n):
    rng = np.random.default_rng(n)
    a, b = rng.random((n, n)), rng.random((n, n))
    left, right = coo(spark, a), coo(spark, b)
    assert np.allclose(dense(matrix.matmul_coo(left, right), (n, n)), a @ b)
    assert np.allclose(dense(matrix.matmul_block(left, right, block=12, group=2), (n, n)), a @ b)


def test_rectangles_and_no_padding(spark):
    rng = np.random.default_rng(1)
    a, b = rng.random((7, 40)), rng.random((40, 3))
    out = matrix.matmul_block(coo(spark, a), coo(spark, b), block=16, group=1)
    assert out.count() == 21
    assert np.allclose(dense(out, (7, 3)), a @ b)


def test_repeated_cells_add_up(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0)], "i bigint, j bigint, v double")
    b = coo(spark, np.array([[4.0]]))
    assert dense(matrix.matmul_coo(a, b), (1, 1)) == [[12]]
    assert dense(matrix.matmul_block(a, b, block=4), (1, 1)) == [[12]]


@pytest.mark.parametrize("chunk_rows", [1, 5, 4096])
def test_hub_inner_index_equals_numpy(spark, chunk_rows):
    rng = np.random.default_rng(2)
    a = (rng.random((30, 12)) < 0.2) * rng.random((30, 12))
    b = (rng.random((12, 25)) < 0.2) * rng.random((12, 25))
    a[:, 3], b[3, :] = 1.0, 2.0
    out = matrix.matmul_coo(coo(spark, a), coo(spark, b), chunk_rows)
    assert np.allclose(dense(out, (30, 25)), a @ b)


def test_both_methods_return_the_same_cells(spark, rows):
    a = np.zeros((9, 7))
    b = np.zeros((7, 8))
    a[0, 1], a[4, 2], a[8, 6], a[8, 1] = 1, 2, 3, 4
    b[1, 0], b[2, 7], b[6, 0], b[5, 5] = 5, 6, -20 / 3, 8
    left, right = coo(spark, a), coo(spark, b)
    sparse, dense_ = (rows(matrix.matmul(left, right, m), "i", "j") for m in ("coo", "block"))
    assert sparse == dense_ == [(0, 0), (4, 7), (8, 0)]
    with pytest.raises(ValueError):
        matrix.matmul(left, right, "other")


@pytest.mark.parametrize("chunk_rows", [2, 1024])
def test_gram_matrix_makes_each_product_once(spark, chunk_rows):
    rng = np.random.default_rng(5)
    x = (rng.random((40, 9)) < 0.3) * rng.random((40, 9))
    x[:, 4] = 1.0
    table = coo(spark, x)
    assert np.allclose(dense(matrix.gram_matrix(table, chunk_rows=chunk_rows), (40, 40)), x @ x.T)
    per_column = (x != 0).sum(axis=0)
    products = matrix.gram_products(table, chunk_rows=chunk_rows).count()
    assert products == int((per_column * (per_column + 1) // 2).sum())
    both_sides = matrix.matmul_coo(table, matrix.transpose(table)).count()
    assert matrix.gram_matrix(table).count() == both_sides


def test_gram_matrix_of_repeated_and_empty_cells(spark):
    x = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (1, 0, 4.0), (1, 1, None)], "i bigint, j bigint, v double")
    assert dense(matrix.gram_matrix(x), (2, 2)).tolist() == [[9, 12], [12, 16]]
    assert matrix.gram_matrix(x.limit(0)).collect() == []


def test_block_products_of_empty_and_many_partials(spark):
    rng = np.random.default_rng(6)
    a, b = rng.random((20, 300)), rng.random((300, 20))
    out = matrix.matmul_block(coo(spark, a), coo(spark, b), block=4, group=1)
    assert np.allclose(dense(out, (20, 20)), a @ b) and out.count() == 400
    assert matrix.matmul_block(coo(spark, a), coo(spark, b).limit(0), block=4).collect() == []


def test_transpose_and_cells(spark, rows):
    table = spark.createDataFrame([(0, [1.0, 2.0])], "id bigint, x array<double>")
    cells = matrix.cells(table)
    assert rows(cells) == [(0, 0, 1.0), (0, 1, 2.0)]
    assert rows(matrix.transpose(cells)) == [(0, 0, 1.0), (1, 0, 2.0)]


def test_max_abs_diff_keeps_small_gaps(spark):
    a, b = coo(spark, np.array([[1.0, 2.0]])), coo(spark, np.array([[1.25, 2.0]]))
    assert compare.max_abs_diff(a, b).first()[0] == 0.25
    assert compare.max_abs_diff(a, coo(spark, np.array([[1.0]]))).first()[0] == 2.0


def test_frame_diff_counts_copies(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "v int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "v int")
    assert rows(compare.frame_diff(a, b)) == [("left", 1, 2), ("left", 2, 1), ("right", 3, 1)]
    assert compare.frame_diff(a, a).count() == 0


def exchanged(df):
    """Bytes that the exchanges of a finished query moved."""
    total, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            waiting.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().get("dataSize").get().value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return total


def test_equal_tables_exchange_digests_only(spark, tmp_path):
    a = spark.range(60_000).selectExpr("id", "concat('row number ', id, ' with some text in it') AS text", "if(id % 7 = 0, null, id / 3) AS v")
    a.repartition(5).write.parquet(str(tmp_path / "b"))
    b = spark.read.parquet(str(tmp_path / "b"))
    same = compare.frame_diff(a, b, buckets=64)
    assert same.collect() == []
    changed = compare.frame_diff(a, b.withColumn("text", F.expr("if(id = 77, 'other', text)")), buckets=64)
    assert sorted((r["side"], r["id"], r["text"][:3], r["copies"]) for r in changed.collect()) == [("left", 77, "row", 1), ("right", 77, "oth", 1)]
    every = compare.frame_diff(a, b.withColumn("v", F.col("id") * 2.0), buckets=64)
    assert len(every.collect()) == 120_000
    # Where nothing differs adaptive execution drops the second pass altogether.
    assert exchanged(same) < exchanged(changed) < exchanged(every) / 10


def test_frame_diff_of_nulls_types_and_nested_columns(spark, rows):
    a = spark.createDataFrame([(None, 1), (2, None)], "x int, y int")
    b = spark.createDataFrame([(1, None), (2, None)], "x bigint, y bigint")
    assert sorted(compare.frame_diff(a, b).collect(), key=repr) == sorted([("left", None, 1, 1), ("right", 1, None, 1)], key=repr)
    nested = "v array<int>, s struct<a:int,b:int>"
    one = spark.createDataFrame([([None, 1], (None, 2)), ([3], None)], nested)
    two = spark.createDataFrame([([1, None], (2, None)), ([3], None)], nested)
    assert compare.frame_diff(one, two).count() == 2 and compare.frame_diff(one, one).count() == 0
    zero, minus = (spark.createDataFrame([(v,), (float("nan"),)], "v double") for v in (0.0, -0.0))
    assert compare.frame_diff(zero, minus).count() == 0
    assert compare.frame_diff(one.limit(0), one.limit(0)).count() == 0
