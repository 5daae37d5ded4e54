"""Collocations against a plain count of every n-gram."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import collocations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, most, order):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und" if lang is None else lang
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, order + 1):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    frequent = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    found = {}
    for (lang, words), a in frequent.items():
        inside = [b for (other, longer), b in frequent.items() if other == lang and len(longer) > len(words)
                  and any(longer[i:i + len(words)] == words for i in range(len(longer)))]
        if any(100 * b >= 100 * a for b in inside):
            continue
        cuts = [(counts[lang, words[:j]], counts[lang, words[j:]]) for j in range(1, len(words))]
        score, at = min((1000 * a * total[lang] // (x * y), j) for j, (x, y) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), *cuts[at], total[lang]))
    return {
        (lang, rank, phrase.decode(), -a, x, y, n, -score)
        for lang, items in found.items() for rank, (score, a, phrase, x, y, n) in enumerate(sorted(items)[:most], 1)
    }


def corpus(n, seed):
    draw = random.Random(seed)
    words = ["New", "york", "city", "hall", "a", "é", "Éa", "x\x1cy", " ", "B" * 300, "#1"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "! ?", ";", ":"]
    weights = [12, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1]
    return [
        ("".join(draw.choice(words) + draw.choices(ends, weights)[0] for _ in range(draw.randint(0, 60))),
         draw.choice(["en", "und", None, "fr"])) for _ in range(n)
    ]


@pytest.mark.parametrize(("least", "order", "most"), [(2, 5, 2000), (4, 3, 7), (3, 2, 50)])
def test_equals_plain_counts(spark, least, order, most):
    rows = corpus(120, least) + [(None, "en"), ("", None), (" \n.", "only breaks"), ("new york city hall new york " * 50, "en")]
    rows += rows[:5]
    docs = spark.createDataFrame([(None, t, lang, "s", 1) for t, lang in rows], DOCS)
    got = collocations.collocations(docs, least, most, order)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == plain(rows, least, most, order)


def test_clashing_columns_and_a_saturated_filter(spark, monkeypatch):
    monkeypatch.setattr(collocations.pair_filter, "__defaults__", (10,))
    monkeypatch.setattr(collocations, "TOKENS", 50)
    rows = corpus(200, 9)
    docs = spark.createDataFrame([(t, lang, "x", 5, 6) for t, lang in rows], "text string, lang string, w1 string, n int, pair int")
    got = {tuple(r) for r in collocations.collocations(docs, 2).collect()}
    assert got == plain(rows, 2, collocations.MOST, 5)


def test_empty_table(documents):
    assert collocations.collocations(documents()).collect() == []


def test_only_frequent_pairs_open_windows(spark):
    rows = [(i, f"alpha beta unique{i} gamma delta") for i in range(30)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    pairs = collocations.counted(docs).filter(F.col("pair").isNotNull() & (F.col("n") >= 30)).select("pair")
    found = [tuple(r.words) for r in collocations.runs(docs, collocations.pair_filter(pairs)).collect()]
    assert Counter(found) == {("alpha", "beta"): 30, ("gamma", "delta"): 30}
    longest = collocations.windows(spark.createDataFrame([("en", ["a", "b", "c"])], "lang string, words array<string>"), 4)
    assert sorted(map(tuple, longest.collect())) == [("en", "a", "b", "c", None), ("en", "b", "c", None, None), ("en", "c", None, None, None)]


def test_filter_holds_all_its_pairs(spark):
    values = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    found = collocations.pair_filter(spark.createDataFrame([(int(v),) for v in values], "pair bigint"))
    assert collocations.passes(values.view(np.uint64), found).all()
    others = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 20_000).view(np.uint64)
    assert collocations.passes(others, found).mean() < 0.05


def test_scores_are_exact(spark):
    cases = [(10**15 + 1, 10**15 + 37, 10**15 + 3, 10**15 + 7), (100, 9_999_999_999_999_999, 100, 100), (3, 7, 3, 5)]
    df = spark.createDataFrame(cases, "a bigint, n bigint, l bigint, r bigint")
    got = [r[0] for r in df.select(collocations.score(*map(F.col, ["a", "n", "l", "r"]))).collect()]
    assert got == [1000 * a * n // (x * y) for a, n, x, y in cases]


def test_workers_hold_few_words_and_pass_on_small_batches():
    """A million words in two languages: few are held as objects, batches stay small and no count is lost."""
    import tracemalloc

    import pyarrow as pa

    text = " ".join(f"word{i % 2003} other{i % 997}" for i in range(50_000))
    full = [pa.RecordBatch.from_pydict({"lang": ["en", "fr"], "text": [text, text]}) for _ in range(5)]
    tracemalloc.start()
    most = max(len(words) for _, words in collocations.by_language(iter(full)))
    totals, singles, pairs = Counter(), Counter(), Counter()
    for batch in collocations.count_batches(iter(full)):
        assert batch.num_rows <= 1 << 16
        for lang, word, pair, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            (totals if word is None and pair is None else singles if pair is None else pairs)[lang] += n
    everything = np.full(1 << 10, -1, dtype=np.int64).view(np.uint64)
    kept = sum(len(batch.column(1).flatten()) for batch in collocations.run_batches(iter(full), everything))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # One text and what is held before it, not all the million words.
    assert most <= 300_000 and peak < 60 << 20
    assert totals == singles == {"en": 500_000, "fr": 500_000} and pairs == {"en": 499_995, "fr": 499_995} and kept == 1_000_000
