import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from corvane.functions import encoding
from corvane.operators import chunks, matrix, ranking, tags

LINES = ["#job #data hiring spark spark", "#job spark engineer", "#cat meow"]


@pytest.fixture
def counts(spark):
    return tags.tag_word_count(spark.createDataFrame([(x,) for x in LINES], "line string"))


@pytest.fixture
def skewed(spark):
    """One word that every tag has, besides rare ones."""
    rng = random.Random(5)
    table = {("#t%02d" % t, "hub"): t + 1 for t in range(60)}
    for t in range(60):
        for _ in range(4):
            table["#t%02d" % t, "w%d" % rng.randrange(30)] = rng.randrange(1, 9)
    rows = [(t, w, c) for (t, w), c in table.items()]
    return rows, spark.createDataFrame(rows, "tag string, word string, cnt bigint")


def brute_similarity(rows):
    vectors = {}
    for tag, word, cnt in rows:
        vectors.setdefault(tag, {})[word] = cnt
    out = {}
    for a, b in combinations(sorted(vectors), 2):
        shared = set(vectors[a]) & set(vectors[b])
        out[a, b] = sum(vectors[a][w] * vectors[b][w] for w in shared) if shared else None
    return out


def test_counts(counts, rows):
    assert rows(counts, "tag", "word", "cnt") == [
        ("#cat", "meow", 1), ("#data", "hiring", 1), ("#data", "spark", 2),
        ("#job", "engineer", 1), ("#job", "hiring", 1), ("#job", "spark", 3),
    ]


def test_repeated_tags_and_words_multiply(spark, rows):
    table = spark.createDataFrame([("#a #a x x x",)], "line string")
    assert rows(tags.tag_word_count(table), "tag", "word", "cnt") == [("#a", "x", 6)]


def test_similarity(counts, rows):
    assert rows(tags.tag_similarity(counts), "a", "b", "similarity") == [("#data", "#job", 7)]
    assert rows(tags.tag_similarity_to(counts, "#job"), "tag", "similarity") == [("#data", 7), ("#job", 11)]


def test_one_tag_filter_equals_filtered_counts(spark, counts, rows):
    lines = spark.createDataFrame([(x,) for x in LINES], "line string")
    one = tags.tag_word_count(lines, "#job")
    assert rows(one, "word", "cnt") == rows(counts.filter("tag = '#job'"), "word", "cnt")


def test_vectors_encode_and_decode(counts, rows):
    encoded = tags.encode_vectors(counts, "tag", "word", segments=1)
    assert ("#job", 0, "engineer:1;hiring:1;spark:3") in rows(encoded, "tag", "segment", "vector")
    assert rows(tags.decode_vectors(encoded, "tag", "word")) == rows(counts, "tag", "word", "cnt")


def test_long_vectors_are_cut_and_stay_whole(skewed, rows):
    _, counts = skewed
    encoded = tags.encode_vectors(counts, "word", "tag", segments=8)
    hub = encoded.filter("word = 'hub'").collect()
    assert len(hub) > 4 and {r["segment"] for r in encoded.collect()} <= set(range(8))
    assert rows(tags.decode_vectors(encoded, "word", "tag"), "word", "tag", "cnt") == rows(counts, "word", "tag", "cnt")


def test_decode_splits_at_the_last_colon(spark):
    got = spark.range(1).select(encoding.decode_vector(F.lit("a:b:3;:1;c:2")).alias("m")).first()["m"]
    assert got == {"a:b": 3, "": 1, "c": 2}


def test_keys_with_colons_come_back(spark, rows):
    table = spark.createDataFrame([("k", "a:b", 3), ("k", "a", 1), ("k", ":", 2)], "key string, feature string, cnt bigint")
    assert rows(tags.decode_vectors(tags.encode_vectors(table, "key", "feature"), "key", "feature")) == rows(table)


def test_decode_accepts_a_closing_separator(spark):
    got = spark.range(1).select(encoding.decode_vector(F.lit("a:1;b:20;")).alias("m")).first()["m"]
    assert got == {"a": 1, "b": 20}


def test_map_dot(spark):
    left, right = F.expr("map('a', 2L, 'b', 3L)"), F.expr("map('b', 5L, 'c', 7L)")
    assert spark.range(1).select(encoding.map_dot(left, right).alias("x")).first()["x"] == 15


@pytest.mark.parametrize("chunk_rows", [1, 7, 4096])
def test_similarity_with_a_hub_word_equals_brute_force(skewed, rows, chunk_rows):
    table, counts = skewed
    expected = brute_similarity(table)
    got = rows(tags.tag_similarity(counts, chunk_rows), "a", "b", "similarity")
    assert got == sorted((a, b, s) for (a, b), s in expected.items() if s is not None)


def test_hub_word_spreads_over_chunk_pairs(skewed):
    _, counts = skewed
    marked = chunks.mark_by_key(counts, "word", "tag", "cnt", 7)
    parts = {r["word"]: r["parts"] for r in marked.select("word", "parts").distinct().collect()}
    assert parts["hub"] == 9
    assert all(p <= 9 for p in parts.values())
    sizes = Counter((r["word"], r["chunk"]) for r in marked.collect())
    assert max(sizes.values()) < 30


def test_gram_matrix_upper_triangle_is_the_similarity(skewed, rows):
    _, counts = skewed
    x = counts.select(F.col("tag").alias("i"), F.col("word").alias("j"), F.col("cnt").alias("v"))
    upper = matrix.gram_matrix(x).filter("i < j")
    assert rows(upper, "i", "j", "v") == rows(tags.tag_similarity(counts), "a", "b", "similarity")


def test_big_products_do_not_wrap(spark, rows):
    table = spark.createDataFrame(
        [("#a", "x", 3_000_000_000), ("#b", "x", 2_000_000_000)], "tag string, word string, cnt bigint"
    )
    assert rows(tags.tag_similarity(table), "similarity") == [(6_000_000_000_000_000_000,)]


def test_global_rank_with_ties(spark):
    rng = random.Random(2)
    values = [(i, rng.choice([0, 0, 0, 1, 2])) for i in range(500)]
    table = spark.createDataFrame(values, "id bigint, s bigint").repartition(7)
    ranked = ranking.global_rank(table, [F.col("s").desc(), F.col("id")]).collect()
    expected = sorted(values, key=lambda v: (-v[1], v[0]))
    assert {(r["id"], r["rank"]) for r in ranked} == {(v[0], n) for n, v in enumerate(expected, 1)}


def test_tag_plans_stay_in_the_jvm_and_combine_early(counts, plan_text):
    plan = plan_text(tags.tag_similarity(counts))
    assert "Python" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "partial_sum" in plan and "partial_count" in plan


def test_normaliser_runs_once_per_scan(spark, plan_text):
    """No inferred size() filter may repeat the normaliser below an explode."""
    table = spark.createDataFrame([(x,) for x in LINES], "line string")
    assert "Filter" not in plan_text(tags.tag_word_count(table)).split("== Initial Plan ==")[0]


def test_lookup_of_a_hub_key_spreads_over_tasks(spark, rows):
    """Without broadcasts, the rows of one key meet its lookup row in many tasks, and none is lost."""
    hub = spark.range(20_000).select(F.lit("hub").alias("word"), F.col("id").cast("string").alias("tag"), F.lit(1).alias("cnt"))
    table = spark.createDataFrame([("hub", 7), ("other", 8)], "word string, parts int")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        met = chunks.salted_lookup(hub, table, "word", "tag")
        assert met.count() == 20_000 and met.filter("parts = 7").count() == 20_000
        assert met.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


def test_similarity_reads_its_text_once(spark, tmp_path):
    """Every branch of a similarity shares one scan of the lines."""
    spark.createDataFrame([(x,) for x in LINES], "line string").coalesce(1).write.parquet(str(tmp_path / "lines"))
    for job in (tags.tag_similarity, lambda c: tags.tag_similarity_to(c, "#job")):
        result = job(tags.tag_word_count(spark.read.parquet(str(tmp_path / "lines"))))
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan parquet") == 1
