import random
from collections import Counter, defaultdict

import pytest

from corvane.operators import tags, top_tags


def table(spark, rows):
    return spark.createDataFrame(rows, "tag string, word string, cnt bigint")


def plain(rows, k):
    vectors = defaultdict(dict)
    for tag, word, cnt in rows:
        vectors[tag][word] = cnt
    out = set()
    for tag, own in vectors.items():
        found = []
        for other, theirs in vectors.items():
            common = own.keys() & theirs.keys()
            if other != tag and common:
                found.append((-sum(own[w] * theirs[w] for w in common), other))
        out |= {(tag, i, other, -s) for i, (s, other) in enumerate(sorted(found)[:k], 1)}
    return out


def zipf(tags_, words, seed, rows):
    draw = random.Random(seed)
    found = Counter()
    for _ in range(rows):
        found[f"#t{int(draw.paretovariate(0.7)) % tags_}", f"w{int(draw.paretovariate(0.5)) % words}"] += draw.choice([1, 1, 1, 9])
    return [(t, w, n) for (t, w), n in found.items()]


@pytest.mark.parametrize(("k", "tags_", "words"), [(1, 40, 500), (3, 40, 30), (5, 6, 2000), (50, 20, 100)])
def test_equals_all_pairs(spark, k, tags_, words):
    rows = zipf(tags_, words, k, 4000)
    assert {tuple(r) for r in top_tags.most_similar(table(spark, rows), k, chunk_rows=16).collect()} == plain(rows, k)


def test_ties_single_words_and_no_partners(spark):
    rows = [(f"#{c}", "same", 1) for c in "dcba"] + [("#alone", "own", 5), ("#x", "xy", 2), ("#y", "xy", 3), ("#y", "own2", 1)]
    assert {tuple(r) for r in top_tags.most_similar(table(spark, rows), 2).collect()} == plain(rows, 2)
    assert top_tags.most_similar(table(spark, rows).limit(0), 2).collect() == []


def test_far_fewer_products_than_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(top_tags, "FIRST_WORDS", 4)
    draw = random.Random(3)
    rows = {}
    # Groups of tags with strong words of their own, and many weak words that all tags share.
    for t in range(60):
        for w in range(6):
            rows[f"#t{t:02}", f"group{t // 4}-{w}"] = draw.randint(50, 99)
        for w in draw.sample(range(400), 150):
            rows[f"#t{t:02}", f"common{w}"] = draw.randint(1, 2)
    counts = table(spark, [(t, w, n) for (t, w), n in rows.items()])
    found = top_tags.search(counts, 2)
    assert {tuple(r) for r in found.ranked.collect()} == plain([(t, w, n) for (t, w), n in rows.items()], 2)
    every = tags.tag_pair_products(counts).count()
    postings = Counter(w for _, w in rows)
    joined = sum(postings[r["word"]] for r in found.head.collect())
    verified = found.verified.count()
    assert joined < every / 10 and verified < 60 * 59 / 5
