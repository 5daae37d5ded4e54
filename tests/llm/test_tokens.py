import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from corvane.llm import common, cutting_stock, elias_fano, packing, token_files
from corvane.llm.encoder import Encoder, tokenizer_path

FILES = [("byte_bpe_50k.json", "lead"), ("word_bpe_49k.json", "drop")]
_encoders = {}


def encoder_of(name, spaces):
    if name not in _encoders:
        _encoders[name] = Encoder(tokenizer_path(name), spaces)
    return _encoders[name]


@pytest.mark.parametrize(("name", "spaces"), FILES)
@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r.,'sdtABéß<|>endoftext0١\x1c\x85 ́Σ"), st.characters(codec="utf-8"))))
def test_cut_encoding_equals_whole(name, spaces, text):
    e = encoder_of(name, spaces)
    assert e.encode(text) == e.whole(text)


@pytest.mark.parametrize(("name", "spaces"), FILES)
def test_full_word_table_is_emptied(name, spaces, monkeypatch):
    monkeypatch.setattr("corvane.llm.encoder.KEPT_WORDS", 3)
    e = Encoder(tokenizer_path(name), spaces)
    text = "one two three four five, one two six."
    assert e.encode(text) == e.whole(text) and e.encode(text) == e.whole(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300), st.integers(1, 50))
def test_elias_fano_round_trip(values, scale):
    values = sorted(v // scale for v in values)
    code = elias_fano.EliasFano(elias_fano.encode(np.array(values, dtype=np.int64)))
    assert code.values().tolist() == values
    if values:
        assert code.select([len(values) - 1, 0]).tolist() == [values[-1], values[0]]
    with pytest.raises(IndexError):
        code.select([len(values)])


def test_elias_fano_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 50_000))
    bits = 8 * len(elias_fano.encode(ends)) / len(ends)
    assert bits <= 2.6 + np.log2(ends[-1] / len(ends))
    with pytest.raises(ValueError):
        elias_fano.encode(np.array([2, 1]))


def brute(rows, name, end):
    tokenizer = encoder_of(*next(f for f in FILES if f[0] == name)).tokenizer
    return [(doc, tokenizer.encode(text or "", add_special_tokens=False).ids + [end]) for doc, text in rows]


@pytest.mark.parametrize("shard_ids", [1, 500, 1 << 20])
def test_files_give_back_every_document(spark, awkward, tmp_path, shard_ids):
    docs = awkward.withColumnRenamed("n_chars", "bucket").withColumnRenamed("lang", "start")
    path = str(tmp_path / "files")
    token_files.write(docs, path, tokenizer_path("byte_bpe_50k.json"), 0, shard_ids=shard_ids)
    got = token_files.read(spark, path).orderBy("start").collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], "byte_bpe_50k.json", 0)
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids)
        want.remove((r.doc_id, ids))
        at += len(ids)
    assert not want
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and [r.doc_id for r in got[len(known):]] == [None, None]
    sums = token_files.digests(spark, path).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in sums] == [
        (r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got
    ]


def test_files_of_an_empty_table(spark, documents, tmp_path):
    path = str(tmp_path / "files")
    token_files.write(documents(), path, tokenizer_path("byte_bpe_50k.json"), 0)
    assert token_files.read(spark, path).collect() == token_files.digests(spark, path).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 400), min_size=1, max_size=20))
def test_patterns_are_feasible_and_near_the_bound(demand):
    sizes = np.array(sorted(demand))
    want = np.array([demand[s] for s in sizes.tolist()])
    columns, uses = cutting_stock.patterns(sizes, want, 32)
    cut = columns.T @ uses if len(uses) else np.zeros(len(sizes))
    assert np.all(columns @ sizes <= 32) and np.all(cut <= want)
    # What is left is less than one use of each pattern.
    assert ((want - cut) * sizes).sum() <= 32 * len(sizes)


def test_knapsack_prices_like_brute_force():
    value, counts = cutting_stock.priced_pattern(np.array([0.2, 0.5, 0.71]), np.array([2, 4, 5]), 11)
    best = max(
        0.2 * a + 0.5 * b + 0.71 * c for a in range(6) for b in range(3) for c in range(3) if 2 * a + 4 * b + 5 * c <= 11
    )
    assert value == pytest.approx(best) and counts @ [2, 4, 5] <= 11


@pytest.mark.parametrize(("size", "grain"), [(4096, 16), (64, 4)])
def test_packing_places_every_id_once(awkward, size, grain):
    docs = awkward.withColumnRenamed("lang", "offset").withColumnRenamed("source", "row")
    got = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), 2, size=size, grain=grain).collect()
    total = {}
    for r in got:
        assert len(r.ids) == r.length * r.width
        total.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in total.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert 0 < at <= size
    want = brute([(r.doc_id, r.text) for r in docs.collect()], "word_bpe_49k.json", 2)
    from collections import Counter

    count = Counter()
    for doc, ids in want:
        count[doc] += len(ids)
    have = Counter()
    for r in got:
        have[r.doc_id] += r.length
    assert have == count
    single = dict((doc, ids) for doc, ids in want if doc in (5, 6, 7, -3))
    for doc, ids in single.items():
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        joined = np.concatenate([np.frombuffer(r.ids, "<u2") for r in mine]).tolist()
        assert joined == ids and [r.start for r in mine][0] == 0 and mine[0].doc_tokens == len(ids)


def test_packing_an_empty_table(documents):
    assert packing.pack(documents(), tokenizer_path("word_bpe_49k.json"), 2).collect() == []


def test_packing_wastes_little(spark, documents):
    draw = np.random.default_rng(2)
    docs = documents(*[(i, "a " * int(n)) for i, n in enumerate(draw.integers(1, 120, 600))])
    got = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), 2, size=128, grain=1).collect()
    full = {}
    for r in got:
        full[r.sequence_id] = full.get(r.sequence_id, 0) + r.length
    padded = sum(128 - n for n in full.values() if n & (n - 1))
    assert padded <= 0.01 * sum(full.values())


def test_tail_is_cut_into_powers_of_two():
    assert packing.tail_cuts(4096 * 2 + 1500, 4096).tolist() == [4096, 8192, 9216, 9472, 9600, 9664, 9680, 9688, 9692]
    assert packing.tail_cuts(0, 4096).tolist() == []


def hot_ids(spark, share):
    """A third of all rows without an id, a third with one id, the rest with ids around it."""
    kind = "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 500 ELSE id END"
    return spark.range(3000).selectExpr(f"CAST({kind} AS BIGINT) AS doc_id", "concat('text ', id, ' of some words') AS text").sample(share, 4)


def test_rows_of_one_id_and_of_none_are_spread_in_order(spark):
    docs = hot_ids(spark, 1.0)
    marked, n = common.key_buckets(docs, "doc_id", F.xxhash64("text"))
    rows = marked.select("bucket", "doc_id", F.xxhash64("text").alias("hash")).collect()
    assert len(rows) == 3000 and 0 <= min(r.bucket for r in rows) and max(r.bucket for r in rows) < n
    order = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.hash))
    assert [r.bucket for r in order] == sorted(r.bucket for r in rows)
    for hot in (None, 500):
        places = [r.bucket for r in rows if r.doc_id == hot]
        assert len(set(places)) >= 8 and max(places.count(p) for p in set(places)) <= 3000 // 20


def test_files_of_hot_ids_give_back_every_document(spark, tmp_path):
    docs = hot_ids(spark, 0.5)
    path = str(tmp_path / "files")
    token_files.write(docs, path, tokenizer_path("byte_bpe_50k.json"), 0)
    got = token_files.read(spark, path).orderBy("start").collect()
    want = sorted(brute([(r.doc_id, r.text) for r in docs.collect()], "byte_bpe_50k.json", 0), key=repr)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=repr) == want
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids) and all(r.doc_id is None for r in got[len(ids):])


def test_successors_of_hot_ids(spark):
    from corvane.llm import minhash

    docs = hot_ids(spark, 0.2)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).collect()
    order = sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), -r.hash))
    want = []
    for one, two in zip(order, [*order[1:], order[0]]):
        edited = minhash.edited_text(one.text, two.text)
        want.append((one.doc_id, hashlib.sha256(edited.encode()).hexdigest()))
    got = [(r.doc_id, r.edited_sha256) for r in minhash.compared(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
