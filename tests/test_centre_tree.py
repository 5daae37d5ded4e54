import pickle

import numpy as np
import pytest

from corvane.operators import lloyd, nearest
from corvane.operators.centre_tree import CentreTree


def clustered(rng, n, d, clusters, spread):
    middle = rng.normal(size=(clusters, d))
    return middle[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, d))


def brute(x, m):
    d2 = np.array([nearest.exact_sq_distance(x, np.broadcast_to(c, x.shape)) for c in m]).T
    return d2.argmin(axis=1), d2.min(axis=1)


@pytest.mark.parametrize("leaf", [1, 3, 32])
def test_equals_brute_force_with_ties_and_equal_centres(leaf):
    rng = np.random.default_rng(3)
    x, m = (rng.integers(0, 5, (n, 3)).astype(float) for n in (700, 90))
    m[40:60] = m[3]
    index, _ = CentreTree(m, leaf).search(x)
    assert (index == brute(x, m)[0]).all()


@pytest.mark.parametrize("far", [0.0, 1e6])
def test_equals_brute_force_whatever_the_scale(far):
    rng = np.random.default_rng(4)
    x, m = far + 1e-3 * rng.random((400, 5)), far + 1e-3 * rng.random((600, 5))
    want, d2 = brute(x, m)
    found, measured = nearest.nearest(x, CentreTree(m))
    assert (found == want).all() and np.array_equal(measured, d2)


def test_few_distances_are_measured_where_centres_lie_in_clusters():
    rng = np.random.default_rng(5)
    x, m = clustered(rng, 5000, 32, 300, 0.1), clustered(np.random.default_rng(5), 6000, 32, 300, 0.1)
    tree = CentreTree(m, 32)
    index, margin = tree.search(x, margin=True)
    plain, apart = nearest.nearest_margin(x, m)
    assert (index == plain).all() and np.allclose(margin, apart, atol=1e-9)
    assert tree.evaluated < 0.1 * len(x) * len(m) and not tree.plain
    again = pickle.loads(pickle.dumps(tree))
    assert (again.search(x)[0] == plain).all()


def test_a_tree_that_does_not_pay_is_left():
    rng = np.random.default_rng(6)
    x, m = rng.random((300, 64)), rng.random((2000, 64))
    tree = CentreTree(m)
    assert (tree.search(x)[0] == nearest.nearest(x, m)[0]).all()
    assert tree.plain and (nearest.nearest(x, tree)[0] == nearest.nearest(x, m)[0]).all()


def test_no_numbers_one_centre_and_wrong_width():
    assert (CentreTree(np.ones((50, 2))).search(np.full((9, 2), np.nan))[0] == 0).all()
    assert (CentreTree(np.ones((1, 2))).search(np.zeros((9, 2)), margin=True)[0] == 0).all()
    with pytest.raises(ValueError):
        CentreTree(np.ones((50, 2))).search(np.zeros((3, 4)))


def test_assignment_and_a_step_through_the_tree(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = clustered(rng, 900, 6, 40, 0.05)
    m = x[rng.choice(900, 120, replace=False)]
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id bigint, x array<double>")

    def both():
        found = sorted(map(tuple, nearest.assign_clusters(table, m, slice_bytes=2048).select("id", "cid", "d2").collect()))
        return found, lloyd.total_arrays(table, m, m + 0.01)

    plain, sums = both()
    monkeypatch.setattr(nearest, "TREE_CENTRES", 2)
    tree, tree_sums = both()
    assert tree == plain
    for a, b in zip(sums, tree_sums, strict=True):
        assert np.array_equal(a, b)
