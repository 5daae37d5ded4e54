import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import bow, lloyd, sampled_kmeans, step_log
from corvane.operators.nearest import assign_by_expression, assign_clusters, nearest
from corvane.sources import binary_points


def point_table(spark, array):
    return spark.createDataFrame(
        [(i, [float(v) for v in row]) for i, row in enumerate(array)], "id bigint, x array<double>"
    )


def brute_nearest(x, m):
    d2 = ((x[:, None, :] - m[None, :, :]) ** 2).sum(axis=2)
    return d2.argmin(axis=1)


def membership(result):
    return [r["cid"] for r in sorted(result.membership.collect(), key=lambda r: r["id"])]


def test_nearest_kernel_equals_brute_force_with_ties():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (500, 3)).astype(float)
    m = rng.integers(0, 4, (40, 3)).astype(float)
    m[7] = m[2]
    index, d2 = nearest(x, m)
    assert (index == brute_nearest(x, m)).all()
    assert np.array_equal(d2, ((x - m[index]) ** 2).sum(axis=1))


def test_nearest_kernel_with_one_centre_many_ties_and_no_numbers():
    x = np.zeros((300, 2))
    assert (nearest(x, np.array([[1.0, 1.0]]))[0] == 0).all()
    assert (nearest(x, np.ones((500, 2)))[0] == 0).all()
    assert (nearest(x + np.nan, np.ones((5, 2)))[0] == 0).all()


def test_nearest_kernel_far_from_the_origin():
    """Rounding of the matrix product must not decide."""
    rng = np.random.default_rng(4)
    m = 1e6 + rng.random((20, 5)) * 1e-3
    x = 1e6 + rng.random((300, 5)) * 1e-3
    assert (nearest(x, m)[0] == brute_nearest(x, m)).all()


@pytest.mark.parametrize("slice_bytes", [16, 48, 1 << 20])
def test_assignment_paths_agree(spark, slice_bytes):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 5, (200, 2)).astype(float)
    m = rng.integers(0, 5, (9, 2)).astype(float)
    table = point_table(spark, x)
    sent = {r["id"]: (r["cid"], r["d2"]) for r in assign_clusters(table, m, slice_bytes=slice_bytes).collect()}
    native = {r["id"]: (r["cid"], r["d2"]) for r in assign_by_expression(table, m).collect()}
    expected = brute_nearest(x, m)
    assert sent == native
    assert [sent[i][0] for i in range(len(x))] == expected.tolist()


def test_lloyd_by_hand(spark):
    table = point_table(spark, [[0], [1], [10], [11]])
    one = lloyd.lloyd(table, 2, max_steps=1)
    assert membership(one) == [0, 1, 1, 1]
    assert np.allclose(one.centre_array.ravel(), [0, 22 / 3])
    done = lloyd.lloyd(table, 2)
    assert membership(done) == [0, 0, 1, 1]
    assert np.allclose(done.centre_array.ravel(), [0.5, 10.5])
    assert [tuple(r) for r in done.trace.orderBy("step").collect()] == [(1, 4, 1.0), (2, 1, 0.25), (3, 0, 0.0)]
    assert done.steps == 3


def test_empty_cluster_keeps_its_centre(spark):
    table = point_table(spark, [[0], [0], [5]])
    one = lloyd.lloyd(table, 2, max_steps=1)
    assert membership(one) == [0, 0, 0]
    assert np.allclose(one.centre_array.ravel(), [5 / 3, 0])
    two = lloyd.lloyd(table, 2, max_steps=2)
    assert membership(two) == [1, 1, 0]
    assert np.allclose(two.centre_array.ravel(), [5, 0])
    assert lloyd.lloyd(table, 2).steps == 3


def test_lloyd_to_convergence_equals_a_plain_loop(spark):
    x = np.random.default_rng(11).random((400, 3))
    centres, old, deltas = x[:6].copy(), np.full(400, -1), []
    while True:
        now = brute_nearest(x, centres)
        deltas.append((now != old).mean())
        old = now
        for c in range(6):
            if (now == c).any():
                centres[c] = x[now == c].mean(axis=0)
        if deltas[-1] <= 0.001:
            break
    result = lloyd.lloyd(point_table(spark, x).repartition(5), 6)
    assert membership(result) == now.tolist()
    assert np.allclose(result.centre_array, centres)
    assert np.allclose([r["delta"] for r in result.trace.orderBy("step").collect()], deltas)
    again = lloyd.lloyd(point_table(spark, x), 6, cache=False)
    assert membership(again) == now.tolist()


def test_membership_is_the_one_before_the_last_means(spark):
    table = point_table(spark, [[0], [1], [10], [11]])
    one = lloyd.lloyd(table, 2, max_steps=1)
    again = [r["cid"] for r in assign_clusters(table, one.centre_array).orderBy("id").collect()]
    assert membership(one) != again


def test_step_cap_counts_executed_steps(spark):
    table = point_table(spark, [[0], [1], [10], [11]])
    assert lloyd.lloyd(table, 2, threshold=-1.0, max_steps=5).steps == 5


def test_lloyd_with_sliced_centres_is_the_same(spark):
    rng = np.random.default_rng(6)
    table = point_table(spark, rng.integers(0, 20, (150, 3)))
    whole = lloyd.lloyd(table, 6)
    sliced = lloyd.lloyd(table, 6, slice_bytes=48)
    assert membership(whole) == membership(sliced)
    assert np.allclose(whole.centre_array, sliced.centre_array)


def test_direct_and_shuffled_sums_agree(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = rng.integers(0, 9, (240, 3)).astype(float)
    table = point_table(spark, x).repartition(6)
    old, new = x[:5], x[5:10]
    direct = lloyd.total_arrays(table, new, old)
    monkeypatch.setattr(lloyd, "DIRECT_BYTES", 0)
    shuffled = lloyd.total_arrays(table, new, old)
    sliced = lloyd.total_arrays(table, new, old, slice_bytes=48)
    now, before = brute_nearest(x, new), brute_nearest(x, old)
    expected = (
        np.bincount(now, minlength=5), np.bincount(now[now != before], minlength=5),
        np.array([x[now == c].sum(axis=0) for c in range(5)]),
    )
    for found in (direct, shuffled, sliced):
        assert all(np.array_equal(f, e) for f, e in zip(found, expected))


def test_sizes_add_up(spark):
    table = point_table(spark, np.random.default_rng(7).random((300, 4)))
    seeds = lloyd.seed_centers(table, 5)
    totals = lloyd.cluster_totals(table, seeds).filter("pos = 0").agg(F.sum("n"), F.sum("changed")).first()
    assert tuple(totals) == (300, 300)


def test_seeds_are_the_lowest_ids(spark):
    table = point_table(spark, [[9], [8], [7]]).orderBy(F.col("id").desc())
    assert lloyd.seed_centers(table, 2).ravel().tolist() == [9, 8]
    with pytest.raises(ValueError):
        lloyd.seed_centers(table, 4)
    with pytest.raises(ValueError):
        lloyd.seed_centers(table, 1)


def test_points_without_a_vector_are_left_out(spark):
    table = spark.createDataFrame([(1, [1.0]), (2, None)], "k bigint, v array<float>")
    assert lloyd.as_points(table, "k", "v").count() == 1


def test_membership_delta(spark):
    old = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id bigint, cid int")
    new = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id bigint, cid int")
    changed, delta = lloyd.membership_delta(old, new).first()
    assert changed == 1 and delta == pytest.approx(1 / 3)


def separated(rng, n=400):
    centres = np.array([[0, 0], [50, 0], [0, 50], [50, 50]], dtype=float)
    return centres, centres[np.arange(n) % 4] + rng.normal(0, 1, (n, 2))


def test_library_kmeans_finds_separated_groups(spark):
    centres, x = separated(np.random.default_rng(8))
    table = point_table(spark, x)
    model = sampled_kmeans.kmeans_ml(table, 4, 20)
    found = np.array([r["m"] for r in sampled_kmeans.ml_centres(table, model).collect()])
    assert (np.abs(found[:, None] - centres[None]).sum(axis=2).min(axis=0) < 1).all()
    keyed = sampled_kmeans.images_by_cluster(table.withColumnRenamed("id", "key"), np.array(model.clusterCenters()))
    assert keyed.groupBy("prediction").count().filter("count = 100").count() == 4


def test_minibatch_uses_every_point_in_every_pass(spark):
    _, x = separated(np.random.default_rng(9), 20_000)
    table = point_table(spark, x)
    start = sampled_kmeans.minibatch_kmeans(table, 4, passes=0).centres
    found = sampled_kmeans.minibatch_kmeans(table, 4, passes=2, batches_per_pass=5)
    assert found.points == 20_000 and found.seen == 2 * 20_000 and found.centres.shape == (4, 2)
    cost = [assign_clusters(table, c).agg(F.sum("d2")).first()[0] for c in (start, found.centres)]
    assert cost[1] <= cost[0]


def test_minibatch_does_not_depend_on_the_partitioning(spark):
    table = point_table(spark, np.random.default_rng(12).random((200, 2)))
    one = sampled_kmeans.minibatch_kmeans(table, 3, passes=2, batches_per_pass=3)
    two = sampled_kmeans.minibatch_kmeans(table.repartition(5), 3, passes=2, batches_per_pass=3)
    assert np.allclose(one.centres, two.centres) and one.seen == two.seen == 400


def test_ragged_and_null_vectors_raise(spark, tmp_path):
    for bad in ([[1.0, 2.0, 3.0], [4.0]], [[1.0, 2.0, 3.0, 4.0], None]):
        table = spark.createDataFrame(list(enumerate(bad)), "id bigint, x array<double>").coalesce(1)
        with pytest.raises(Exception, match="vector"):
            assign_clusters(table, np.zeros((2, 2))).collect()
        with pytest.raises(Exception, match="vector"):
            lloyd.total_arrays(table, np.zeros((2, 2)))
        with pytest.raises(Exception, match="vector"):
            binary_points.write_binary_points(table, str(tmp_path / "bad"))


@pytest.mark.parametrize("k", [2, 4, 8, 16, 32, 64, 128])
def test_assignment_variants_agree(spark, k):
    x = np.random.default_rng(k).random((400, 9))
    table, centres = point_table(spark, x), x[:k]
    whole = {r["id"]: r["cid"] for r in assign_clusters(table, centres).collect()}
    sliced = {r["id"]: r["cid"] for r in assign_clusters(table, centres, slice_bytes=9 * 8 * 3).collect()}
    in_jvm = {r["id"]: r["cid"] for r in assign_by_expression(table, centres).collect()}
    assert whole == sliced == in_jvm


def test_moved_points_are_counted_as_a_full_comparison_does(spark):
    draw = np.random.default_rng(3)
    x = draw.random((600, 3))
    old, new = x[:20], x[:20] + draw.normal(0, 0.02, (20, 3))
    n, changed, _ = lloyd.total_arrays(point_table(spark, x), new, old)
    a = ((x[:, None] - old) ** 2).sum(axis=2).argmin(axis=1)
    b = ((x[:, None] - new) ** 2).sum(axis=2).argmin(axis=1)
    assert changed.sum() == (a != b).sum() > 0 and n.sum() == 600


def test_large_codebooks_fill_histograms(spark):
    words = spark.createDataFrame([("a", i, w) for i, w in enumerate([0, 9999, 9999, 5])], "image_id string, descriptor_id bigint, word int")
    counts = bow.bow_histogram(words, 10_000).first()["counts"]
    assert len(counts) == 10_000 and sum(counts) == 4 and (counts[0], counts[5], counts[9999]) == (1, 1, 2)


def test_assignment_neither_shuffles_nor_grows_rows(spark, plan_text):
    table = point_table(spark, np.random.default_rng(1).random((50, 3)))
    plan = plan_text(assign_clusters(table, np.zeros((4, 3))))
    assert "Exchange" not in plan and "MapInArrow" in plan


def test_bag_of_words_by_hand(spark, rows):
    table = spark.createDataFrame(
        [("a", 1, [1.0, 1.0]), ("a", 2, [9.0, 9.0]), ("a", 3, [11.0, 10.0]), ("c", 4, [5.0, 5.0])],
        "image_id string, descriptor_id bigint, x array<double>",
    )
    words = bow.quantize(table, np.array([[0.0, 0.0], [10.0, 10.0]]))
    assert rows(words) == [("a", 1, 0), ("a", 2, 1), ("a", 3, 1), ("c", 4, 0)]
    hist = {r["image_id"]: r["counts"] for r in bow.bow_histogram(words, 2).collect()}
    assert hist == {"a": [1, 2], "c": [1, 0]}
    features = bow.bow_feature(words, 2)
    got = {r["image_id"]: r["feature"] for r in features.collect()}
    assert got["a"] == pytest.approx([0.447214, 0.894427], abs=1e-6)
    images = spark.createDataFrame([("a", "u/a"), ("b", "u/b")], "image_id string, url string")
    emitted = sorted(map(tuple, bow.bow_rows(images, features).collect()))
    assert emitted == [("666", "u/a", "[0.447214, 0.894427]"), ("666", "u/b", None)]


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_a_pass_reads_every_place_once(spark, batches):
    places = batches * sampled_kmeans.PLACES
    for turn in range(3):
        dealt = sampled_kmeans.batches_of_pass(turn, places, batches)
        assert len(dealt) == batches and sorted(p for b in dealt for p in b) == list(range(places))
    assert batches == 1 or sampled_kmeans.batches_of_pass(0, places, batches) != sampled_kmeans.batches_of_pass(1, places, batches)


def test_a_batch_opens_only_the_files_of_its_places(spark, plan_text):
    table = point_table(spark, np.random.default_rng(13).random((500, 2)))
    stored, path = sampled_kmeans.dealt(table, 8)
    read = 0
    for batch in sampled_kmeans.batches_of_pass(0, 8, 4):
        part = stored.filter(F.col("place").isin(batch))
        # Directories are left out before a file is opened; no row is read to be thrown away.
        assert "PartitionFilters: [place" in plan_text(part) and "DataFilters: []" in plan_text(part)
        read += part.count()
    assert read == 500 and len(stored.inputFiles()) >= 8
    assert sorted(r["id"] for r in stored.collect()) == list(range(500))


class Lost(Exception):
    pass


def same_run(one, two):
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(one.trace) == key(two.trace) and key(one.membership) == key(two.membership)
    assert np.array_equal(one.centre_array, two.centre_array) and one.steps == two.steps


@pytest.mark.parametrize("lost_at", [0, 1, 2, 4])
def test_a_run_is_taken_up_again(spark, tmp_path, monkeypatch, lost_at):
    x = np.random.default_rng(14).integers(0, 40, (300, 2)).astype(float)
    table = point_table(spark, x).repartition(3, "id")
    whole = lloyd.lloyd(table, 6, threshold=0.0)
    assert whole.steps > 5
    write = step_log.StepLog.write

    def fail(self, step):
        if step.step == lost_at:
            # What a driver leaves when it is lost while it writes.
            half = step_log.Step(step.step, step.changed, step.n, step.centres)
            rows = [(half.step, 6, half.changed, half.n, 0, half.centres[0].tolist())]
            spark.createDataFrame(rows, step_log.SCHEMA).write.parquet(f"{self.folder}/{half.step:08d}")
            raise Lost
        write(self, step)

    log = str(tmp_path / "log")
    monkeypatch.setattr(step_log.StepLog, "write", fail)
    with pytest.raises(Lost):
        lloyd.lloyd(table, 6, threshold=0.0, log=log)
    monkeypatch.setattr(step_log.StepLog, "write", write)
    same_run(lloyd.lloyd(table, 6, threshold=0.0, log=log), whole)
    # A finished run is not run again.
    monkeypatch.setattr(step_log.StepLog, "write", None)
    same_run(lloyd.lloyd(table, 6, threshold=0.0, log=log), whole)


def test_a_log_of_another_run_raises(spark, tmp_path):
    x = np.random.default_rng(15).random((60, 2))
    table, log = point_table(spark, x), str(tmp_path / "log")
    lloyd.lloyd(table, 3, threshold=-1, max_steps=2, log=log)
    with pytest.raises(ValueError, match="another run"):
        lloyd.lloyd(table, 4, threshold=-1, max_steps=3, log=log)
    with pytest.raises(ValueError, match="points"):
        lloyd.lloyd(table.filter("id > 9"), 3, threshold=-1, max_steps=3, log=log)
    with pytest.raises(ValueError, match="another run"):
        lloyd.lloyd(table, 3, threshold=-1, max_steps=3, seeds=x[10:13], log=log)


def test_the_sweep_gives_one_result_whichever_way_points_are_assigned(spark):
    x = np.random.default_rng(16).integers(0, 30, (400, 3)).astype(float)
    table = point_table(spark, x)
    for k in (2, 4, 8, 16, 32, 64, 128):
        runs = [lloyd.lloyd(table, k, threshold=-1, max_steps=2, slice_bytes=size) for size in (1 << 20, 24 * max(1, k // 3))]
        seeds = lloyd.seed_centers(table, k)
        first = {tuple(r) for r in assign_by_expression(table, seeds).select("id", "cid").collect()}
        assert first == {tuple(r) for r in assign_clusters(table, seeds).select("id", "cid").collect()}
        same_run(*runs)
