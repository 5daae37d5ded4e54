import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvane.functions import text
from corvane.operators import ngrams

NORMALIZED = [
    ("12 34 56 a", "4 a"),
    ("3rd place 1984", "rd place"),
    ("#job, is http://a.b/c?x=1 great!! --- ok", "#job is great! ok"),
    ("Foo:bar;baz #a:b #C++ @me $5", "foo bar baz #a b #c+ @me"),
    ("_lead =x 7up", "lead x up"),
    ("  ...  ", ""),
    ("", ""),
    ("http://t.co/ab. end", "end"),
]


@pytest.mark.parametrize("line,expected", NORMALIZED)
def test_normalize(spark, line, expected):
    got = spark.range(1).select(text.normalize(F.lit(line)).alias("x")).first()["x"]
    assert got == expected


def test_colons_can_stay(spark):
    got = spark.range(1).select(text.normalize(F.lit("foo:bar x"), colons=False).alias("x")).first()["x"]
    assert got == "foo:bar x"


def test_control_characters_are_trimmed(spark):
    got = spark.range(1).select(text.squeeze(F.lit("\x01 a\tb \x1f")).alias("x")).first()["x"]
    assert got == "a b"


def test_empty_line_has_one_empty_token(spark):
    got = spark.range(1).select(text.tokenize(F.lit("")).alias("x")).first()["x"]
    assert got == [""]


@pytest.mark.parametrize(
    "body,expected",
    [("a\nb", ["a", "b"]), ("a\nb\n", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]), ("", []), ("\n", [""]),
     ("a\n\n", ["a", ""])],
)
def test_lines(spark, body, expected):
    got = spark.range(1).select(text.text_lines(F.lit(body)).alias("x")).first()["x"]
    assert got == expected


def test_lines_match_a_text_scan(spark, tmp_path):
    body = "one\ntwo\r\n\nthree\rfour\n"
    (tmp_path / "in.txt").write_bytes(body.encode())
    scanned = sorted(r["value"] for r in spark.read.text(str(tmp_path)).collect())
    split = spark.range(1).select(F.explode(text.text_lines(F.lit(body))).alias("x")).collect()
    assert sorted(r["x"] for r in split) == scanned


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_ngrams_are_windows(spark, n):
    words = ["a", "b", "c", "d"]
    tokens = F.array(*map(F.lit, words))
    got = spark.range(1).select(text.ngrams(tokens, n).alias("x")).first()["x"]
    assert got == [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


def test_ngram_count(spark, rows):
    lines = spark.createDataFrame(
        [("#job #data hiring spark spark",), ("#job spark engineer",), ("#cat meow",)], "line string"
    )
    bigrams = rows(ngrams.ngram_count(lines, 2), "gram", "cnt")
    assert bigrams == sorted(
        (g, 1) for g in ["#job #data", "#data hiring", "hiring spark", "spark spark", "#job spark",
                         "spark engineer", "#cat meow"]
    )
    four = rows(ngrams.ngram_count(lines, 4), "gram")
    assert four == [("#data hiring spark spark",), ("#job #data hiring spark",)]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab #,.:;1 \t", max_size=20), min_size=1, max_size=8))
def test_tokens_hold_no_separators(spark, lines):
    table = spark.createDataFrame([(line,) for line in lines], "line string")
    for row in ngrams.token_table(table).collect():
        assert row["tokens"]
        assert not any(re.search(r"[\s:;]", t) for t in row["tokens"])
