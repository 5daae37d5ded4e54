import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from corvane.llm import buckets, components, minhash, simhash


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def plain_print(text, k=4):
    found = words_of(text)
    if not found:
        return 0
    shingles = [b" ".join(found[i:i + k]) for i in range(max(1, len(found) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids, radius):
    low = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = low[i], low[j]
                low = [min(a, b) if x in (a, b) else x for x in low]
    groups = {}
    for root, doc in zip(low, ids):
        groups.setdefault(root, []).append(doc)
    lowest = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return [lowest[r] for r in low]


def near_texts(n, seed):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        base = [draw.choice("abcdefgh") * draw.randint(1, 4) for _ in range(draw.randint(1, 80))]
        out.append(" ".join(base))
        for _ in range(draw.randint(0, 4)):
            copy = list(base)
            copy[draw.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    return out


def test_near_duplicates_equal_brute_force(documents):
    texts = near_texts(60, 3) + [None, "", " \n", "One two", "one  TWO", "É one"]
    rows = [(None if i % 31 == 7 else i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    got = simhash.near_duplicates(documents(*rows), 4, 64, 4)
    prints = [plain_print(t) for _, t in rows]
    want = sorted(zip((d for d, _ in rows), prints, plain_components(prints, [d for d, _ in rows], 4)), key=repr)
    have = sorted(((r.doc_id, int.from_bytes(r.fp), r.component_id) for r in got.collect()), key=repr)
    assert have == want
    assert len({c for _, _, c in have}) < len({f for _, f, _ in have})


def test_near_duplicates_of_an_empty_table(documents):
    assert simhash.near_duplicates(documents()).collect() == []


def test_block_masks_miss_no_pair_within_the_radius():
    draw = np.random.default_rng(1)
    masks = simhash.block_masks(6, 4, 64)
    one = draw.integers(0, 1 << 64, 2000, dtype=np.uint64)
    two = one.copy()
    for i in range(4):
        two ^= np.uint64(1) << draw.integers(0, 64, 2000, dtype=np.uint64)
    meets = ((one[:, None] ^ two[:, None]) & masks[:, 0]) == 0
    assert len(masks) == 15 and meets.any(axis=1).all()


@pytest.mark.parametrize("bits", [64, 256])
def test_pairs_of_a_bucket_equal_brute_force(bits):
    draw = np.random.default_rng(5)
    prints = draw.integers(0, 1 << 64, (60, bits // 64), dtype=np.uint64)
    prints[20:] = prints[:20].repeat(2, axis=0)
    prints[20:, 0] ^= np.uint64(1) << draw.integers(0, 64, 40, dtype=np.uint64)
    runs = np.repeat([0, 1], [45, 15])
    a, b, apart = simhash.near_pairs(prints, runs, 4)
    want = {
        (i, j) for j in range(60) for i in range(j)
        if runs[i] == runs[j] and int(np.bitwise_count(prints[i] ^ prints[j]).sum()) <= 4
    }
    assert set(zip(a.tolist(), b.tolist())) == want and want
    assert apart.tolist() == np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1).tolist()


def test_large_bucket_is_cut_into_chunks_without_loss(spark, documents, monkeypatch):
    monkeypatch.setattr(buckets, "met", lambda slots, chunk=5, met=buckets.met: met(slots, chunk))
    texts = near_texts(25, 9)
    got = simhash.near_duplicates(documents(*enumerate(texts))).collect()
    prints = [plain_print(t) for t in texts]
    want = plain_components(prints, list(range(len(texts))), 4)
    assert [r.component_id for r in sorted(got, key=lambda r: r.doc_id)] == want


def test_representatives_keep_one_row_per_group(documents):
    text = "one two three four five six seven eight"
    docs = documents((4, text, "en", "b"), (2, text, "en", "z"), (2, text, "en", "a"), (None, text), (9, "else " * 9), (None, ""), (None, None))
    found = simhash.near_duplicates(docs, 5, 256, 54, simhash.drawn_masks(64, 18, 256), 0.8)
    kept = simhash.representatives(docs, found).collect()
    assert sorted(((r.doc_id, r.source) for r in kept), key=repr) == [(2, "a"), (9, None), (None, None)]


def test_wide_fingerprints_find_texts_with_small_edits(documents):
    draw = random.Random(4)
    base = [[f"w{draw.randrange(5000)}" for _ in range(300)] for _ in range(40)]
    rows = []
    for i, text in enumerate(base):
        copy = list(text)
        for _ in range(5):
            copy[draw.randrange(300)] = "edit"
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(copy))]
    docs = documents(*rows)
    found = simhash.near_duplicates(docs, 5, 256, 54, simhash.drawn_masks(64, 18, 256), 0.8).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i // 2 * 2 for i in range(80)}


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, i) for i in range(1001, 1100)]
    edges = spark.createDataFrame(chain + star + [(7, 7), (5, 4), (5, 4)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)}
    assert components.components(edges.limit(0)).collect() == []
    nulls = spark.createDataFrame([(None, 1), (2, None), (4, 3)], "a bigint, b bigint")
    assert {tuple(r) for r in components.components(nulls).collect()} == {(3, 3), (4, 3)}


@pytest.mark.parametrize("shape", ["sorted chain", "random", "two hubs"])
def test_components_take_few_rounds(spark, shape):
    n = 10_000
    ids = spark.range(n)
    if shape == "sorted chain":
        edges = ids.selectExpr("id AS a", "id + 1 AS b")
        want = n + 1, 1
    elif shape == "random":
        edges = ids.selectExpr("id AS a", f"pmod(xxhash64(id), {n}) AS b")
        want = None
    else:
        edges = ids.selectExpr("pmod(id, 2) - 2 AS a", "id AS b").union(spark.createDataFrame([(-1, -2)], "a bigint, b bigint"))
        want = n + 2, 1
    found, rounds = components.contracted(edges)
    # The estimate that joins multiply is that of written files, however many rounds there were.
    size = found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert rounds <= 20 and int(str(size)).bit_length() <= 64
    got = {r.node: r.root for r in found.collect()}
    if want:
        assert (len(got), len(set(got.values()))) == want
    pairs = [tuple(r) for r in edges.collect()]
    nodes = sorted({x for p in pairs for x in p})
    at = {x: i for i, x in enumerate(nodes)}
    a, b = (np.array([at[p[i]] for p in pairs]) for i in (0, 1))
    low = buckets.merged(len(nodes), a, b)
    assert got == {x: nodes[low[i]] for i, x in enumerate(nodes)}


def test_minhash_rows_follow_the_contract(documents, awkward):
    rows = awkward.collect()
    got = minhash.compared(awkward.withColumnRenamed("lang", "seat")).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    ids = [r.doc_id for r in order]
    hasher = minhash.Hasher()
    by_id = {r.doc_id: r for r in got if ids.count(r.doc_id) == 1}
    for i, r in enumerate(order):
        if ids.count(r.doc_id) > 1 or ids.count(ids[(i + 1) % len(ids)]) > 1:
            continue
        text, after = r.text or "", order[(i + 1) % len(order)].text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        mine = by_id[r.doc_id]
        assert mine.n_chars == len(text) and mine.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert mine.fingerprint == hasher.of(text).tobytes() and mine.edited_fingerprint == hasher.of(edited).tobytes()
        assert mine.near_edited == minhash.likeness(hasher.of(text), hasher.of(edited))
        assert mine.near_next == minhash.likeness(hasher.of(text), hasher.of(after))


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_minhash_successor_over_many_ranges(documents, n):
    texts = [f"text number {i} with a few words" for i in range(n)]
    got = {r.doc_id: r for r in minhash.compared(documents(*enumerate(texts))).collect()}
    assert len(got) == n
    for i, text in enumerate(texts):
        half = len(text) // 2
        edited = text[:len(text) - half] + texts[(i - 1) % n][:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_likeness_estimates_jaccard():
    draw = random.Random(8)
    hasher = minhash.Hasher()
    errors = []
    for _ in range(40):
        a = [f"w{draw.randrange(900)}" for _ in range(400)]
        cut = draw.randrange(400)
        b = a[:cut] + [f"v{draw.randrange(900)}" for _ in range(400 - cut)]
        sets = [{tuple(t[i:i + 5]) for i in range(396)} for t in (a, b)]
        true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        errors.append(minhash.likeness(hasher.of(" ".join(a)), hasher.of(" ".join(b))) - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert minhash.likeness(hasher.of(""), hasher.of(" ")) == 1.0


def test_minhash_links_are_exact_and_complete(documents):
    draw = random.Random(2)
    texts = []
    for _ in range(12):
        base = [f"w{draw.randrange(3000)}" for _ in range(120)]
        texts.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            copy[draw.randrange(120)] = f"x{draw.randrange(9)}"
            texts.append(" ".join(copy))
    texts += [None, "", "short one", texts[0]]
    edges = minhash.near_pairs(documents(*enumerate(texts)))
    got = components.components(edges.select("a", "b"))
    sets = [frozenset(tuple(words_of(t)[i:i + 5]) for i in range(max(1, len(words_of(t)) - 4))) for t in texts[:48]]
    near = [(i, j) for j in range(48) for i in range(j) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8]
    assert near and all(r.jaccard >= 0.8 for r in edges.collect())
    groups = {}
    for i, j in near:
        groups.setdefault(i // 4, set()).update((i, j))
    assert got.count() == sum(map(len, groups.values()))
    assert got.select("root").distinct().count() == len(groups)


def test_spanning_edges_equal_a_plain_forest():
    draw = np.random.default_rng(4)
    for n, m in [(1, 0), (5, 3), (30, 60), (40, 400)]:
        a, b = draw.integers(0, n, m), draw.integers(0, n, m)
        a, b = a[a != b], b[a != b]
        cost = draw.integers(0, 6, len(a))
        parent, want = list(range(n)), 0

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        trees = 0
        for i in np.argsort(cost, kind="stable"):
            x, y = root(a[i]), root(b[i])
            if x != y:
                parent[x] = y
                want += cost[i]
                trees += 1
        kept = buckets.spanning_edges(n, a, b, cost)
        low = buckets.merged(n, a[kept], b[kept])
        assert len(kept) == trees and cost[kept].sum() == want
        assert len(set(low.tolist())) == n - trees == len({root(x) for x in range(n)})


def test_merged_chains_and_rings():
    draw = np.random.default_rng(8)
    order = draw.permutation(500)
    a, b = order[:-1], order[1:]
    assert (buckets.merged(500, a, b) == 0).all()
    half = np.arange(500) % 2
    keep = half[a] == half[b]
    got = buckets.merged(500, a[keep], b[keep])
    for i in range(500):
        assert half[got[i]] == half[i] and got[i] <= i


def straddling(n, seed):
    """Near copies of one text of 300 words whose similarities lie on both sides of 0.8, and their exact components."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(300)]
    texts = []
    for i in range(n):
        copy = list(base)
        for at in draw.sample(range(300), draw.randint(3, 9)):
            copy[at] = f"x{draw.randrange(10 ** 6)}"
        texts.append(" ".join(copy))
    sets = [frozenset(zip(*(words_of(t)[k:] for k in range(5)), strict=False)) for t in texts]
    low = list(range(n))
    for i in range(n):
        for j in range(i):
            if low[i] != low[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low = [min(low[i], low[j]) if x in (low[i], low[j]) else x for x in low]
    return texts, low


def test_wide_fingerprints_lose_no_link_of_a_large_group(documents):
    texts, want = straddling(400, 21)
    found = simhash.near_duplicates(documents(*enumerate(texts)), 5, 256, 54, simhash.drawn_masks(64, 18, 256), 0.8).collect()
    assert 20 < len(set(want)) < 380
    assert [r.component_id for r in sorted(found, key=lambda r: r.doc_id)] == want


def test_minhash_loses_no_link_of_a_large_group(documents):
    texts, want = straddling(400, 22)
    docs = documents(*enumerate(texts))
    hashes = {r.h: r.doc_id for r in docs.selectExpr("xxhash64(text) h", "doc_id").collect()}
    low = list(range(400))
    for r in minhash.near_pairs(docs).collect():
        i, j = low[hashes[r.a]], low[hashes[r.b]]
        low = [min(i, j) if x in (i, j) else x for x in low]
        assert r.jaccard >= 0.8
    assert 20 < len(set(want)) < 380 and low == want


def test_exact_links_equal_brute_force():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.choice(60, draw.integers(0, 40))).astype("<u4") for _ in range(80)]
    sets += [s[draw.random(len(s)) > 0.05] for s in sets] + sets[:40]
    a, b, jaccard = minhash.exact_links(sets, 0.8)
    exact = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y)) if len(x) or len(y) else 1.0
    near = [(i, j) for j in range(200) for i in range(j) if exact(sets[i], sets[j]) >= 0.8]
    assert set(zip(a.tolist(), b.tolist())) <= set(near) and len(near) > len(a) > 0
    assert jaccard.tolist() == [exact(sets[i], sets[j]) for i, j in zip(a, b)]
    assert (buckets.merged(200, a, b) == buckets.merged(200, *np.array(near).T)).all()


def test_texts_of_one_fingerprint_are_linked_by_similarity_only(documents, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprint", lambda hashes, bits=64: bytes(bits // 8))
    rows = [(1, "a b c d e f g h"), (2, "A b c d e f g H"), (3, "q r s t u v w x"), (4, None), (5, " ")]
    found = simhash.near_duplicates(documents(*rows), 5, 256, 54, simhash.drawn_masks(64, 18, 256), 0.8).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}


def test_components_run_what_gives_their_edges_once(spark):
    ran = spark.sparkContext.accumulator(0)

    def edges(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    found = components.components(spark.range(40).selectExpr("id AS a", "id + 1 AS b").mapInArrow(edges, "a bigint, b bigint"))
    assert {r.root for r in found.collect()} == {0}
    assert ran.value == 40


def test_slots_are_shuffled_once_to_meet(spark, plan_text):
    slots = spark.createDataFrame([(i % 3, bytes([i])) for i in range(30)], "slot bigint, item binary")
    plan = plan_text(buckets.met(slots, 5))
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_representatives_shuffle_texts_once(spark, documents, plan_text):
    docs = documents((0, "a"), (0, "b"), (None, "b"), (None, "c"), (None, None), (None, ""), (3, "a"), (3, "a"))
    hashed = docs.selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS text_hash")
    found = spark.createDataFrame([(*r, r.text_hash) for r in hashed.collect()], "doc_id bigint, text_hash bigint, root bigint")
    kept = simhash.representatives(docs, found)
    # Rows by root, what is chosen, and the texts.
    assert plan_text(kept).count("Exchange hashpartitioning") == 3
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == [(0, "a"), (0, "b"), (None, "c"), (None, None)]
