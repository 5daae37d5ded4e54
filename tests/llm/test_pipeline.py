"""The pipeline against a plain version, stage by stage and as a whole."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from corvane.llm import quality_ranking
from corvane.llm.encoder import Encoder, tokenizer_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    draw = random.Random(11)
    word = lambda: "".join(draw.choice(["ka", "lo", "mi", "ter", "sun", "ver"]) for _ in range(draw.randint(1, 3)))
    rows, labels = [], []
    for i in range(150):
        text = "\n".join(" ".join(word() for _ in range(draw.randint(8, 30))).capitalize() + "." for _ in range(draw.randint(2, 6)))
        rows.append((i, text, "en", f"s{draw.randrange(4)}", len(text)))
        labels.append((i, 1, 0))
    for i in range(150, 190):
        rows.append((i, "".join(word().upper() + "!! " for _ in range(60)), "en", "s1", 0))
        labels.append((i, 0, 0))
    for i in range(190, 200):
        rows.append((i, f"{word()} " * 50, "en", "s2", 0))
    for i in range(200, 230):
        words = rows[i - 200][1].split(" ")
        if i % 2:
            words[draw.randrange(len(words))] = "edited"
        rows.append((i, " ".join(words), "en", None, 0))
    rows += [(230, None, None, None, None), (231, "", "en", "s0", 0), (None, rows[5][1], "en", "s3", None), rows[7]]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels = corpus()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """Results of the stages, each read from what the one before wrote."""
    out = str(tmp_path_factory.mktemp("stages"))
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    found["input"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
        found[name] = docs.collect()
    return found


def bag(rows):
    return Counter((r.doc_id, r.text, r.source) for r in rows)


def passes_rules(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    return len(words) >= 20 and 100 * len(covered) <= 30 * len(words)


def test_rules_stage(stages):
    # No line stands in more than 30 texts of a source, so only the base rules decide here.
    assert bag(stages["quality_rules"]) == bag(r for r in stages["input"] if passes_rules(r.text))


def test_classifier_stage(spark, folder, stages):
    ranker = quality_ranking.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    want = [r for r in stages["quality_rules"] if ranker.score(quality_ranking.measures(r.text)[None])[0] >= 0.3]
    assert bag(stages["quality_classifier"]) == bag(want)
    ids = {r.doc_id for r in stages["quality_classifier"]}
    assert not ids & set(range(150, 200)) and set(range(150)) <= ids | {r.doc_id for r in stages["input"] if not passes_rules(r.text)}


def shingles(text):
    words = [w.lower() for w in WORDS.findall(text)]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_dedup_stage(stages):
    rows = stages["quality_classifier"]
    sets = [shingles(r.text) for r in rows]
    low = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low = [min(low[i], low[j]) if x in (low[i], low[j]) else x for x in low]
    groups = {}
    for root, r in zip(low, rows):
        groups.setdefault(root, []).append(r.doc_id)
    want = Counter(min((d for d in g if d is not None), default=None) for g in groups.values())
    assert Counter(r.doc_id for r in stages["simhash_near_dedup"]) == want
    assert len(want) < len(rows)


def test_mixing_stage(stages):
    rows = stages["simhash_near_dedup"]
    size = {r.doc_id: len(WORDS.findall(r.text)) for r in rows}
    sources = sorted({r.source for r in rows}, key=lambda s: (s is None, s))
    total = {s: sum(size[r.doc_id] for r in rows if r.source == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(2 * total[s], weight[s] * level) for s in sources) < 1.5 * sum(total.values()) else (low, level)
    want = Counter()
    for s in sources:
        target = min(2 * total[s], weight[s] * high)
        whole = int(target / total[s] + 1e-9)
        left = round(target - whole * total[s])
        order = sorted((r for r in rows if r.source == s), key=lambda r: hashlib.md5(f"mix-1/{r.doc_id}".encode()).hexdigest()[:15])
        for r in order:
            part = max(0, min(left, size[r.doc_id]))
            left -= part
            want[r.doc_id] += whole * size[r.doc_id] + part
    have = Counter()
    for r in stages["mixing"]:
        have[r.doc_id] += len(WORDS.findall(r.text))
    assert have == +want


def test_packing_stage(stages):
    encode = Encoder(tokenizer_path("word_bpe_49k.json"), "drop")
    want = Counter()
    for r in stages["mixing"]:
        want[r.doc_id] += len(encode.whole(r.text)) // 2 + 1
    have, fill = Counter(), {}
    for p in stages["packing"]:
        have[p.doc_id] += p.length
        fill.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert have == want
    for pieces in fill.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096


def test_whole_run_equals_its_stages(spark, folder, stages):
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert Counter(map(key, corpus_pipeline.run(spark, folder).collect())) == Counter(map(key, stages["packing"]))


def test_empty_documents_pass_through(spark, documents, folder):
    docs = documents()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect() == []
