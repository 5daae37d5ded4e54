import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corvane.functions import labels, vectors
from corvane.operators import classify
from corvane.sources import models


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_prefix_labels(spark):
    names = ["images/classification/all_souls_1.jpg", "ashmolean.jpg", "x/ch_1", "hertford", "ra", "distractor"]
    got = [one(spark, labels.label_from_prefix(F.lit(n))) for n in names]
    assert got == [1, 2, 3, 4, 5, None]


def test_suffix_label_and_hidden_names(spark):
    assert one(spark, labels.label_from_suffix(F.lit("small ring|4d.jpg"))) == 4
    assert one(spark, labels.is_hidden(F.lit(".x"))) and not one(spark, labels.is_hidden(F.lit("x")))


def test_class_names(spark):
    assert one(spark, labels.class_name(F.lit(1), labels.OBJECT_CLASSES)) == "airplane"
    assert one(spark, labels.class_name(F.lit(11), labels.OBJECT_CLASSES)) is None


def test_statistics_and_standardising(spark):
    table = spark.createDataFrame([(i, [float(i), 5.0 * i]) for i in (1, 2, 3)], "id bigint, x array<double>")
    stats = [tuple(r) for r in classify.channel_stats(table).orderBy("pos").collect()]
    assert np.allclose(stats, [(0, 2, 1), (1, 10, 5)])
    scaled = classify.standardize(table, classify.fit_scaler(table)).orderBy("id").collect()
    assert np.allclose([r["x"] for r in scaled], [[-1, -1], [0, 0], [1, 1]])


def test_evaluation(spark):
    judged = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "label int, pred int")
    assert tuple(classify.accuracy(judged).first()) == (2, 3, pytest.approx(2 / 3))
    classes = labels.class_table(spark, ["a", "b", "c"])
    got = sorted(map(tuple, classify.per_class_accuracy(judged, classes).collect()))
    assert got == [(1, "a", 1, 2, 0.5), (2, "b", 1, 1, 1.0), (3, "c", 0, 0, None)]
    counted = sorted(map(tuple, classify.label_counts(judged, classes).collect()))
    assert counted == [(1, "a", 2), (2, "b", 1), (3, "c", 0)]


def test_vector_functions(spark):
    x = F.expr("array(3d, 4d)")
    assert one(spark, vectors.sq_distance(x, F.expr("array(0d, 0d)"))) == 25
    assert one(spark, vectors.distance(x, F.expr("array(0d, 0d)"))) == 5
    assert one(spark, vectors.l2_normalize(x)) == pytest.approx([0.6, 0.8])
    assert one(spark, vectors.l2_normalize(F.expr("array(0d, 0d)"))) == [None, None]
    assert sum(one(spark, vectors.softmax(x))) == pytest.approx(1)
    assert one(spark, vectors.softmax(F.expr("array(1000d, 1000d)"))) == [0.5, 0.5]
    scores = F.expr("array(0.2d, 0.4d, 0.4d)")
    assert tuple(one(spark, vectors.top_class(scores))) == (0.4, 1)
    assert [s["cls"] for s in one(spark, vectors.class_ranking(scores))] == [1, 2, 0]
    assert one(spark, vectors.exponentials(F.expr("array(0d)"))) == [1]


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (300, 4))
    rows = [(i, [float(v) for v in r], int(r[0] > 0) + 2 * int(r[1] > 0)) for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, "id bigint, x array<double>, label int")
    return table, classify.train_classifier(table, 4, max_iter=60)


def test_training_learns_and_survives_storage(spark, trained, tmp_path):
    table, model = trained
    scored = classify.score_batch(model, table, ["a", "b", "c", "d"])
    met = scored.join(table, "id").select((F.col("label") + 1).alias("label"), F.col("cls").alias("pred"))
    ours = classify.accuracy(met).first()["accuracy"]
    assert ours > 0.9
    doubles = met.select(F.col("label").cast("double"), F.col("pred").cast("double"))
    library = MulticlassClassificationEvaluator(labelCol="label", predictionCol="pred", metricName="accuracy")
    assert library.evaluate(doubles) == pytest.approx(ours)
    models.save_model(model, str(tmp_path / "m"))
    again = classify.score_batch(models.load_model(str(tmp_path / "m")), table, ["a", "b", "c", "d"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))


def test_embedding_leads_to_the_scores_of_the_network(trained):
    table, model = trained
    embedded = {r["id"]: np.array(r["embedding"]) for r in classify.embed_penultimate(model, table).collect()}
    assert len(embedded) == 300 and len(embedded[0]) == 84
    matrix, offset = classify.layer_weights(model.stages[1])[-1]
    scored = model.transform(table.withColumn("features", classify.array_to_vector("x")))
    for row in scored.select("id", vector_to_array("probability").alias("p")).take(20):
        raw = embedded[row["id"]] @ matrix + offset
        p = np.exp(raw - raw.max())
        assert np.allclose(p / p.sum(), row["p"])
