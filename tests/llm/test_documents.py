import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvane.llm import mixing, quality_rules, token_rollup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    "a b c d e f g h\na b c d e f g h i", "x " * 40, "one\n\none\n one\none", "#|<> $$ %&* \U0001F600é",
    " ".join(map(str, range(30))) + " 5 6 7 8 9 10 11 12 tail", "a b c d e f g a b c d e f g a b c d e f g",
]


def test_base_measures_equal_brute_force(awkward, documents):
    docs = awkward.union(documents(*enumerate(TEXTS, 50))).withColumnRenamed("lang", "words").withColumnRenamed("n_chars", "kept")
    got = quality_rules.judged(quality_rules.measured(docs)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    have = sorted(((r.doc_id, *(r[n] for n in names), r.base_failed) for r in got), key=repr)
    want = []
    for r in docs.collect():
        b = base(r.text)
        want.append((r.doc_id, *b, b[0] < 20 or 100 * b[4] > 30 * b[0]))
    assert have == sorted(want, key=repr)
    assert not any(r.kept and r.base_failed for r in got)


def common_docs():
    """Six documents share a footer; two of them have little else. Another host has the footer twice."""
    footer = "All  RIGHTS reserved by the footer people of this very host and nobody else"
    body = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, f"{body(i, 40)}\n{footer}", "en", "big") for i in range(4)]
    rows += [(4, f"{footer.lower()}\n{footer}\n{body(4, 3)}", "en", "big"), (5, f"{footer}\t\n{body(5, 8)}", "en", "big")]
    rows += [(10, f"{footer}\n{body(10, 10)}", "en", "small"), (11, f"{footer}\n{body(11, 10)}", "en", "small")]
    return rows, footer


def test_lines_above_the_limits_go_and_depleted_documents_are_rejected(documents):
    rows, footer = common_docs()
    docs = documents(*rows, rows[4])
    limits = {"min_docs": 3, "share": 0.5}
    got = {r.doc_id: r for r in quality_rules.judged(quality_rules.measured(docs), **limits).collect()}
    n = len(footer.split())
    assert {i: got[i].removed_words for i in got} == {0: 0, 1: n, 2: n, 3: n, 4: 2 * n, 5: n, 10: 0, 11: 0}
    assert {i for i in got if not got[i].kept} == {4}
    clean = quality_rules.cleaned(docs, **limits).collect()
    assert sorted(r.doc_id for r in clean) == [0, 1, 2, 3, 5, 10, 11]
    for r in clean:
        assert (footer in r.text) == (r.doc_id in (0, 10, 11)) and r.n_chars == len(r.text)
    # Copies are one document: five equal texts make no line frequent.
    copies = documents(*[(i, rows[0][1], "en", "big") for i in range(9)])
    assert all(r.kept and not r.removed_words for r in quality_rules.judged(quality_rules.measured(copies), **limits).collect())


def test_rules_of_an_empty_table_and_null_hosts(documents):
    assert quality_rules.cleaned(documents()).collect() == []
    long = " ".join(f"w{i}" for i in range(30))
    docs = documents((None, long, None, None), (None, long, None, None), (1, long, None, ""))
    assert quality_rules.cleaned(docs).count() == 3


def test_rules_use_no_python(documents, plan_text):
    table = quality_rules.measured(documents((1, "a b")))
    assert "Python" not in plan_text(quality_rules.judged(table)) and "Python" not in plan_text(quality_rules.features(documents((1, "a"))))


def fill(sizes, weights, total, epochs):
    """Targets by a bisection on the water level."""
    goal, low, high = total * sum(sizes), 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(s * epochs, w * level) for s, w in zip(sizes, weights)) < goal:
            low = level
        else:
            high = level
    return [min(s * epochs, w * high) for s, w in zip(sizes, weights)]


def test_mix_meets_targets_and_reruns_agree(documents):
    rows = [(i, "w " * (i % 37 + 1), "en", f"s{i % 5 if i % 3 else 0}") for i in range(400)]
    rows += [(1000 + i, "w " * 3000, "en", None) for i in range(3)] + [(2000, None, "en", "s1"), (2001, "", "en", "zero")]
    docs = documents(*rows).withColumnRenamed("lang", "target").withColumnRenamed("n_chars", "size")
    mixed = mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", mixing.taken().alias("taken"))
    got = {r.doc_id: r for r in mixed.collect()}
    assert len(got) == len(rows)
    assert got == {r.doc_id: r for r in mixing.mix(docs.repartition(7)).select(*mixed.columns[:-1], mixing.taken().alias("taken")).collect()}
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s))
    sizes = [sum(len((t or "").split()) for _, t, _, s in rows if s == name) for name in sources]
    want = fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5, 2)
    for name, size, target in zip(sources, sizes, want):
        mine = [r for r in got.values() if r.source == name]
        assert {r.source_size for r in mine} == {size} and mine[0].target == pytest.approx(target, rel=1e-6, abs=1e-6)
        assert sum(r.taken for r in mine) == pytest.approx(target, abs=1)
    assert all(0 <= r.taken <= 2 * r.size for r in got.values())


def test_repetitions_take_the_words_they_should(documents):
    rows = [(i, f"a{i}  b\n\tc d e", "en", "x" if i % 2 else "y", 10) for i in range(21)] + [(3, "a3  b\n\tc d e", "en", "x", 10)]
    docs = documents(*rows)
    mixed = mixing.mix(docs)
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id] += r.whole * r.size + r.part
    out = mixing.repeated(mixed, docs.columns).collect()
    have = Counter()
    for r in out:
        have[r.doc_id] += len(r.text.split())
        assert f"a{r.doc_id}  b\n\tc d e".startswith(r.text) and r.n_chars == len(r.text)
    assert have == +want
    assert mixing.repeated(mixing.mix(documents()), docs.columns).collect() == []
    assert [mixing.taken() is not None, mixing.mix(documents((1, None), (2, " "))).filter("whole + part > 0").count()] == [True, 0]


COUNTS = "doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint, docs bigint"


def test_rollup_follows_signed_batches(spark, tmp_path):
    store = str(tmp_path / "rollup")
    table = lambda *rows: spark.createDataFrame([(*r, None) for r in rows], COUNTS)
    assert token_rollup.totals(spark, store).collect() == []
    first = table((1, "a", "en", "v1", 10), (2, "a", "en", "v1", 5), (3, None, None, "v1", None), (4, "b", "fr", "v1", 7), (4, "b", "fr", "v1", 7))
    assert token_rollup.commit(store, "1", token_rollup.inserts(first))
    assert not token_rollup.commit(store, "1", token_rollup.inserts(first))
    have = lambda s=store: {tuple(r)[:3]: tuple(r)[3:] for r in token_rollup.totals(spark, s).collect()}
    assert have() == {("a", "en", "v1"): (2, 15), (None, None, "v1"): (1, 0), ("b", "fr", "v1"): (2, 14)}
    token_rollup.commit(store, "2", token_rollup.deletes(first.filter("doc_id = 4")))
    token_rollup.commit(store, "3", token_rollup.changes(first.filter("doc_id = 1"), table((1, "a", "en", "v2", 12))))
    token_rollup.commit(store, "4", token_rollup.revisions(first.filter("doc_id = 2").withColumn("old_tokens", F.lit(5)).withColumn("n_tokens", F.lit(9))))
    token_rollup.commit(store, "5", token_rollup.inserts(first.limit(0)))
    want = {("a", "en", "v1"): (1, 9), ("a", "en", "v2"): (1, 12), (None, None, "v1"): (1, 0)}
    assert have() == want
    # A batch whose log row was never written does not count, and may be sent again with other rows.
    token_rollup.inserts(first).groupBy(*token_rollup.KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.parquet(f"{store}/deltas/batch=6")
    assert have() == want
    assert token_rollup.commit(store, "6", token_rollup.inserts(first.filter("doc_id = 1")))
    want["a", "en", "v1"] = (2, 19)
    assert have() == want
    other = str(tmp_path / "compact")
    token_rollup.compacted(spark, store, other, "base")
    assert have(other) == want and not token_rollup.commit(other, "4", token_rollup.inserts(first))
