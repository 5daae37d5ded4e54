import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corvane.operators import postings, tags


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**63)), max_size=60))
def test_seven_bit_groups_give_numbers_back(values):
    raw = postings.packed(np.array(values, dtype=np.uint64))
    assert postings.unpacked(raw).tolist() == values
    assert len(raw) <= sum(max(1, -(-(v.bit_length() + 1) // 7)) for v in values)


def table(spark, seed=2):
    draw = random.Random(seed)
    rows = {}
    for key in range(12):
        for word in draw.sample(range(3000), 2500 if key == 0 else 40):
            rows[f"#k{key}", f"word{word}"] = draw.choice([1, 1, 2, 130, 10**12])
    return spark.createDataFrame([(k, w, n) for (k, w), n in rows.items()], "tag string, word string, cnt bigint"), rows


@pytest.mark.parametrize("span", [1, 64, postings.SPAN])
def test_round_trip_equals_the_long_table(spark, span):
    counts, rows = table(spark)
    numbered = postings.numbers(counts, "word").cache()
    found = postings.encode(counts, numbered, "tag", "word", span)
    assert {(r.tag, r.word): r.cnt for r in postings.decode(found, numbered, "tag", "word").collect()} == rows
    assert sorted(r.number for r in numbered.collect()) == list(range(numbered.count()))
    assert found.filter(f"n > {span}").count() == 0


def test_one_key_and_one_entry(spark, tmp_path, plan_text):
    counts, rows = table(spark, 3)
    numbered = postings.numbers(counts, "word").cache()
    place = {r.word: r.number for r in numbered.collect()}
    path = str(tmp_path / "postings")
    postings.encode(counts, numbered, "tag", "word", 256).write.parquet(path)
    stored = spark.read.parquet(path)
    one = postings.of_key(stored, numbered, "#k3", "tag", "word")
    assert "EqualTo(key,#k3)" in plan_text(one)
    assert {(r.tag, r.word): r.cnt for r in one.collect()} == {k: n for k, n in rows.items() if k[0] == "#k3"}
    for word in ("word5", "word17", "word2999"):
        if word in place:
            assert postings.entry(stored, "#k0", place[word], 256) == rows.get(("#k0", word), 0)
    assert postings.entry(stored, "#missing", 3, 256) == 0


def test_smaller_than_text_and_empty(spark):
    counts, _ = table(spark, 4)
    numbered = postings.numbers(counts, "word").cache()
    packed = postings.encode(counts, numbered, "tag", "word").selectExpr("sum(length(data) + 20)").first()[0]
    text = tags.encode_vectors(counts, "tag", "word").selectExpr("sum(length(vector))").first()[0]
    assert packed < text / 3
    assert postings.encode(counts.limit(0), numbered, "tag", "word").collect() == []
