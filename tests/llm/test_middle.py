"""Boundary sets against plain position lists, and rearranged texts against plain strings."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corvane.llm import boundary_set, fill_in_middle
from corvane.llm.boundary_set import BoundarySet


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300_000), st.integers(1, 9000), st.sampled_from([1, 2, 3, 40])), max_size=6))
def test_select_gives_back_positions(blocks):
    """Runs, dense and sparse stretches, so that all three forms occur."""
    positions = np.unique(np.concatenate([np.zeros(0, dtype=int), *(np.arange(a, a + n, step) for a, n, step in blocks)]))
    found = BoundarySet(positions)
    assert len(found) == len(positions)
    for k in {0, len(positions) // 3, len(positions) - 1} & set(range(len(positions))):
        assert found.select(k) == positions[k]
    for k in (-1, len(positions)):
        with pytest.raises(IndexError):
            found.select(k)


def test_forms_of_containers():
    span = boundary_set.SPAN
    sparse, dense, run = np.arange(0, span, 1000), np.arange(span, 2 * span, 3), np.arange(2 * span, 3 * span)
    found = BoundarySet(np.concatenate([sparse, dense, run]))
    assert [form for form, _ in found.containers] == [boundary_set.ARRAY, boundary_set.BITMAP, boundary_set.RUN]
    every = np.concatenate([sparse, dense, run])
    assert [found.select(k) for k in range(0, len(every), 997)] == every[::997].tolist()
    assert found.n_bytes() == 2 * len(sparse) + span // 8 + 4
    with pytest.raises(ValueError):
        BoundarySet(np.array([2, 1]))


@pytest.mark.parametrize("text", ["", "a", "é", "a" * 65_535, "a" * 65_536, "é" * 40_000, "aé\U0001F600" * 30_000, "é" * 32_768 + "a" * 70_000])
def test_boundaries_of_a_text(text):
    raw = text.encode()
    found = BoundarySet.of_text(raw)
    assert len(found) == len(text) + 1
    for k in {0, 1, len(text) // 2, len(text) // 3, len(text) - 1, len(text)} & set(range(len(text) + 1)):
        assert found.select(k) == len(text[:k].encode())


def plain(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(st.integers(-100, 10**6), st.text(alphabet=st.one_of(st.sampled_from("<>PSM aé"), st.characters(codec="utf-8"))))
def test_output_and_way_back(doc_id, text):
    want = plain(doc_id, text)
    found = fill_in_middle.formed(doc_id, text.encode())
    assert found[:4] == want[:4] and found[4].decode() == want[4]
    assert fill_in_middle.restored(found[4], found[1]).decode() == text


def test_rows_follow_the_contract(spark, awkward, documents):
    marked = documents(*((i, f"text {i} with <{'PSMX'[i % 4]}> inside" if i % 3 else f"ünï {i} " * i) for i in range(20, 300)))
    docs = awkward.union(marked).withColumnRenamed("n_chars", "n").withColumnRenamed("lang", "form").withColumnRenamed("source", "output")
    rows = docs.collect()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(r.doc_id, *plain(r.doc_id, r.text)) for r in rows]
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted((tuple(r) for r in fill_in_middle.transformed(docs).collect()), key=key) == sorted(want, key=key)
    summed = [(*w[:5], digest(w[5]), digest(r.text or "")) for w, r in zip(want, rows)]
    assert sorted((tuple(r) for r in fill_in_middle.digests(docs).collect()), key=key) == sorted(summed, key=key)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fill_in_middle.transformed(documents()).collect() == []
