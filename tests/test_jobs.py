import numpy as np
import pytest

from corvane import jobs
from corvane.operators import classify
from corvane.sources import models


def lines_of(spark, path):
    return [r["value"] for r in spark.read.text(str(path)).collect()]


@pytest.fixture
def posts(tmp_path):
    first, second = tmp_path / "a.txt", tmp_path / "b.txt"
    first.write_text("#job #data hiring spark spark\n#job spark engineer\n")
    second.write_text("#cat meow\n")
    return [str(first), str(second)]


def test_similarity_job(spark, posts, tmp_path):
    jobs.tag_similarity_job(spark, posts, str(tmp_path / "out"))
    assert lines_of(spark, tmp_path / "out") == ["7\t#data\t#job"]


def test_ngram_job(spark, posts, tmp_path):
    jobs.ngram_job(spark, posts, str(tmp_path / "out"), 4)
    assert sorted(lines_of(spark, tmp_path / "out")) == [
        "#data hiring spark spark\t1", "#job #data hiring spark\t1"
    ]


@pytest.mark.parametrize("binary", [False, True])
def test_kmeans_job(spark, tmp_path, binary):
    path = tmp_path / "points"
    values = np.array([[0], [1], [10], [11]], dtype="<f4")
    if binary:
        path.write_bytes(np.array(values.shape, "<i4").tobytes() + values.tobytes())
    else:
        path.write_text("".join(f"{i} {v}\n" for i, (v,) in enumerate(values)))
    result = jobs.kmeans_job(spark, str(path), 2, binary=binary)
    assert result.steps == 3
    assert sorted(lines_of(spark, f"{path}.cluster_centres")) == ["0 0.500000", "1 10.500000"]
    assert sorted(lines_of(spark, f"{path}.membership")) == ["0 0", "1 0", "2 1", "3 1"]


def test_image_jobs(spark, tmp_path):
    images = spark.createDataFrame([(i, f"u/{i}") for i in range(7)], "image_id bigint, url string")
    near, far = [1.0, 1.0], [9.0, 9.0]
    descriptors = spark.createDataFrame(
        [(i, j, near if i % 2 else far) for i in range(6) for j in range(3)],
        "image_id bigint, descriptor_id bigint, x array<double>",
    )
    codebook = spark.createDataFrame([(0, [0.0, 0.0]), (1, [10.0, 10.0])], "cid int, m array<double>")
    jobs.image_features_job(images, descriptors, codebook, str(tmp_path / "features"))
    lines = sorted(lines_of(spark, tmp_path / "features"))
    assert lines[0] == "666\tu/0\t[0.000000, 1.000000]" and lines[6] == "666\tu/6\t"
    jobs.image_cluster_job(spark, str(tmp_path / "features"), str(tmp_path / "clusters"), 2, 10)
    found = dict(line.split("\t")[::-1] for line in lines_of(spark, tmp_path / "clusters"))
    assert len(found) == 6
    assert len({found[f"u/{i}"] for i in (1, 3, 5)}) == len({found[f"u/{i}"] for i in (0, 2, 4)}) == 1
    assert found["u/0"] != found["u/1"]


def test_classify_job(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.normal(3 * (i % 2), 0.1, 2)], i % 2) for i in range(60)]
    table = spark.createDataFrame(rows, "id bigint, x array<double>, label int")
    models.save_model(classify.train_classifier(table, 2, max_iter=30), str(tmp_path / "model"))
    jobs.classify_job(table, str(tmp_path / "model"), ["even", "odd"], str(tmp_path / "out"))
    fields = [line.split("\t") for line in lines_of(spark, tmp_path / "out")]
    assert {(int(f[2]) % 2, f[0], f[3]) for f in fields} == {(0, "1", "even"), (1, "2", "odd")}
    assert all(0.5 < float(f[1]) <= 1 for f in fields)
