"""SimHash near-duplicates found with pivot distance tables.

A fingerprint has a bit set where over half of the shingle hashes have it.
Rows with one fingerprint are one class from the start; pairs are sought
between distinct fingerprints only.

Two fingerprints that differ in few bits agree on whole groups of bits, so
classes meet in buckets of equal bit groups: with ``blocks`` blocks and at most
``radius`` differing bits, ``blocks - radius`` blocks agree (:func:`block_masks`,
complete for any pair). Inside a bucket every fingerprint has a row of Hamming
distances to ``PIVOTS`` reference fingerprints. By the triangle inequality no
pair is within ``radius`` if some coordinate differs by more, so pairs are
discarded by their maximum coordinate difference, and only survivors are
compared bit by bit. A task gives a spanning forest of what it finds, not pairs.

Large buckets are cut into chunks that meet pairwise in separate tasks
(:mod:`corvane.llm.buckets`); nothing is capped. Null texts count as empty; a text without
words has fingerprint zero and links like any other.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corvane.llm import buckets, minhash
from corvane.llm.common import stored
from corvane.llm.components import components
from corvane.session import frozen

PIVOTS = 16
SEED = 42


def mixed64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle, repeats included; A-Z count as a-z."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    ends = list(itertools.accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a : b - 1], SEED) for a, b in zip(starts, ends[words - 1 :], strict=False)]
    return np.array(hashes, dtype=np.uint64)


def fingerprint(hashes: np.ndarray, bits: int = 64) -> bytes:
    """Majority bits, most significant byte first; bits past 64 come from words mixed out of each hash."""
    n = len(hashes)
    if not n:
        return bytes(bits // 8)
    counts = np.zeros(bits, dtype=np.int64)
    salts = mixed64(np.arange(1, bits // 64, dtype=np.uint64) << np.uint64(32))
    # Rows are added up as bytes, which must not pass 255.
    for at in range(0, n, 255):
        block = hashes[at : at + 255, None]
        wide = np.concatenate([block, mixed64(block ^ salts)], axis=1) if bits > 64 else block
        set_bits = np.unpackbits(wide.astype(">u8").view(np.uint8).reshape(len(block), -1), axis=1)
        counts += np.add.reduce(set_bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > n).tobytes()


def fingerprint_column(text: Column, words: int = 4, bits: int = 64) -> Column:
    @pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(shingle_hashes(t, words), bits) for t in texts], dtype=object)

    return of(text)


def block_masks(blocks: int = 6, radius: int = 4, bits: int = 64) -> np.ndarray:
    """All choices of ``blocks - radius`` of the blocks: one of them agrees for any pair within ``radius``."""
    edges = np.linspace(0, bits, blocks + 1).astype(int)
    rows = []
    for chosen in itertools.combinations(range(blocks), blocks - radius):
        row = np.zeros(bits, dtype=np.uint8)
        for b in chosen:
            row[edges[b] : edges[b + 1]] = 1
        rows.append(row)
    return as_words(np.packbits(np.array(rows), axis=1).tobytes(), bits)


def drawn_masks(tables: int, width: int, bits: int, seed: int = 7) -> np.ndarray:
    """``tables`` seeded choices of ``width`` bits, for radii that no blocks can serve."""
    draw = np.random.default_rng(seed)
    rows = np.zeros((tables, bits), dtype=np.uint8)
    for row in rows:
        row[draw.choice(bits, width, replace=False)] = 1
    return as_words(np.packbits(rows, axis=1).tobytes(), bits)


def as_words(raw: bytes, bits: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=">u8").astype(np.uint64).reshape(-1, bits // 64)


def pivot_table(prints: np.ndarray, seed: int = 11) -> np.ndarray:
    """Hamming distances of each fingerprint to the reference fingerprints."""
    pivots = np.random.default_rng(seed).integers(0, 1 << 64, (PIVOTS, prints.shape[1]), dtype=np.uint64)
    return np.stack([np.bitwise_count(prints ^ p).sum(axis=1, dtype=np.int16) for p in pivots], axis=1)


def near_pairs(prints: np.ndarray, runs: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of near fingerprints with the same run number, and their distances; ``runs`` is sorted."""
    table = pivot_table(prints)
    first, second, distance = ([np.zeros(0, dtype=np.int32)] for _ in range(3))
    left = np.arange(len(prints), dtype=np.int32)
    for step in itertools.count(1):
        left = left[left + step < len(prints)]
        left = left[runs[left] == runs[left + step]]
        if not len(left):
            return np.concatenate(first), np.concatenate(second), np.concatenate(distance)
        a, b = left, left + np.int32(step)
        for column in range(PIVOTS):
            fits = np.abs(table[a, column] - table[b, column]) <= radius
            a, b = a[fits], b[fits]
        apart = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int32)
        fits = apart <= radius
        first.append(a[fits])
        second.append(b[fits])
        distance.append(apart[fits])


def links(classes: DataFrame, masks: np.ndarray, radius: int, bits: int) -> DataFrame:
    """``(a, b)`` edges between the distinct ``fp`` of ``classes``: their components are those of all near pairs."""
    keyed_schema = pa.schema([("slot", pa.int64()), ("item", pa.binary())])

    def to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            prints = as_words(b"".join(column.to_pylist()), bits)
            for number, mask in enumerate(masks):
                slot = np.full(len(prints), number + 1, dtype=np.uint64)
                for word in range(prints.shape[1]):
                    slot = mixed64(slot * np.uint64(0x9E3779B97F4A7C15) ^ (prints[:, word] & mask[word]))
                yield pa.RecordBatch.from_arrays([pa.array(slot.view(np.int64)), column], schema=keyed_schema)

    slots = classes.select("fp").mapInArrow(to_slots, "slot bigint, item binary")

    def to_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(number: np.ndarray, raw: np.ndarray) -> pa.RecordBatch:
            a, b, _ = near_pairs(as_words(raw.tobytes(), bits), number, radius)
            low = buckets.merged(len(raw), a, b)
            b = np.flatnonzero(low != np.arange(len(low)))
            a = low[b]
            ends = [pa.array([raw[i].tobytes() for i in at], pa.binary()) for at in (a, b)]
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        return buckets.runs(batches, bits // 8, found)

    return buckets.met(slots).mapInArrow(to_links, "a binary, b binary").distinct()


def near_duplicates(
    docs: DataFrame, words: int = 4, bits: int = 64, radius: int = 4, masks: np.ndarray | None = None,
    similar: float | None = None,
) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` of every row.

    ``component_id`` is the smallest doc_id reachable over near fingerprints;
    null ids reach others but are never the smallest, and a component without
    any id gets null. ``root`` names the component. With ``similar``, the
    components of fingerprints are candidate groups only: distinct texts of a
    group, also those of one fingerprint, are linked if their shingle sets have
    that exact Jaccard similarity.
    """
    prints = stored(docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        fingerprint_column(F.col("text"), words, bits).alias("fp"),
    ), "simhash")
    first_last = [F.min("text_hash").alias("text"), *([F.max("text_hash").alias("last")] if similar is not None else [])]
    classes = frozen(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), *first_last))
    masks = block_masks(radius=radius, bits=bits) if masks is None else masks
    roots = components(links(classes, masks, radius, bits))
    key = "fp"
    if similar is not None:
        key = "text_hash"
        groups = classes.join(roots, classes["fp"] == roots["node"], "left").filter(
            F.col("root").isNotNull() | (F.col("text") != F.col("last"))
        ).select("fp", F.coalesce("root", "fp").alias("slot"))
        members = prints.select(F.col("text_hash").alias("h"), "fp").distinct().join(groups, "fp").select("h", "slot")
        hashed = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
        roots = components(minhash.linked(hashed, members, similar, words).select("a", "b"))
        classes = prints.groupBy("text_hash").agg(F.min("doc_id").alias("low"))
    of_class = classes.join(roots, classes[key] == roots["node"], "left").select(
        key, "low", F.coalesce("root", key).alias("root")
    )
    lowest = of_class.groupBy("root").agg(F.min("low").alias("component_id"))
    # Stored on its own, so the join with the rows may split a fingerprint that a third of them share.
    named = frozen(of_class.join(lowest, "root").select(key, "root", "component_id"))
    return prints.join(named, key).select("doc_id", "text_hash", "fp", "root", "component_id")


def representatives(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` per component of ``found``: lowest id (nulls last), then lowest text hash.

    Rows that agree in both are reduced to one before they meet, and the join has
    the keys of that grouping (a null id as a flag), so texts are shuffled once.
    """
    first = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("doc"), F.col("text_hash").alias("hash"))
    # Components without any id have a null number; their fingerprint root tells them apart.
    no, doc, own = (F.col(f"first.{c}").alias(f"__{c}") for c in ("no", "doc", "hash"))
    chosen = found.groupBy("root").agg(F.min(first).alias("first")).select(no, F.coalesce(doc, F.lit(0)).alias("__doc"), own).distinct()
    row = F.min(F.struct(*[c for c in docs.columns if c != "doc_id"])).alias("row")
    rows = docs.groupBy(
        F.col("doc_id").isNull().alias("__no"), F.coalesce("doc_id", F.lit(0)).alias("__doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("__hash"),
    ).agg(row)
    kept = rows.join(chosen, ["__no", "__doc", "__hash"], "left_semi")
    return kept.select(F.when(~F.col("__no"), F.col("__doc")).alias("doc_id"), "row.*").select(*docs.columns)
