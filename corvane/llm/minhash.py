"""MinHash fingerprints of whole texts, likeness of fingerprints, and near-duplicate pairs.

A text is the set of its shingles of ``WORDS`` words (A-Z as a-z; a shorter
text is one shingle, one without words none). Every shingle gets a 32-bit
number, each of ``PERMUTATIONS`` universal permutations ``a * x + b`` (odd
``a``, modulo 2**32) is applied to all numbers at once in numpy, and the
fingerprint keeps 16 mixed bits of each minimum. The share of equal places of
two fingerprints estimates the Jaccard similarity of the sets.

Null texts count as empty. Two texts without words have likeness 1.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corvane.llm import buckets
from corvane.llm.common import key_buckets, stored, tasks
from corvane.llm.components import components

WORDS = 5
PERMUTATIONS = 128
BANDS = 32
SIMILAR = 0.8
BLOCK = 1024
#: Chunks of shingle sets that meet: most bytes, and rows where tasks are free; rows of links in a batch.
CHUNK_BYTES = 8 << 20
SPREAD_CHUNK = 128
LINK_ROWS = 10_000

_BASE = 0x5851F42D4C957F2D
_UNBASE = pow(_BASE, -1, 1 << 64)


class Hasher:
    """Shingle numbers and fingerprints; tables of powers grow with the longest text seen."""

    def __init__(self, words: int = WORDS, permutations: int = PERMUTATIONS, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.words = words
        self.permutations = permutations
        self.byte = draw.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.a = draw.integers(0, 1 << 32, permutations, dtype=np.uint32) | np.uint32(1)
        self.b = draw.integers(0, 1 << 32, permutations, dtype=np.uint32)
        self.powers = self.inverses = np.ones(0, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 1 << 16)
            steps = np.full(n, _BASE, dtype=np.uint64)
            steps[0] = 1
            self.powers = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = _UNBASE
            self.inverses = np.cumprod(steps, dtype=np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """32-bit numbers of all shingles, repeats included."""
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return np.zeros(0, dtype=np.uint32)
        line = np.frombuffer(b" ".join(found), dtype=np.uint8)
        self._grow(len(line) + 1)
        sums = np.zeros(len(line) + 1, dtype=np.uint64)
        np.cumsum(self.byte[line] * self.powers[: len(line)], out=sums[1:])
        ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        span = min(self.words, len(found))
        starts, ends = starts[: len(found) - span + 1], ends[span - 1 :]
        # Divided by the power at the start, equal shingles have equal values wherever they stand.
        value = (sums[ends] - sums[starts]) * self.inverses[starts]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return (value >> np.uint64(32)).astype(np.uint32)

    def fingerprint(self, numbers: np.ndarray) -> np.ndarray:
        low = np.full(self.permutations, 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(numbers), BLOCK):
            block = numbers[at : at + BLOCK, None] * self.a + self.b
            np.minimum(low, block.min(axis=0), out=low)
        return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2")

    def of(self, text: str | None) -> np.ndarray:
        return self.fingerprint(self.shingles(text))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def edited_text(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def beside_next(docs: DataFrame, columns: str = "doc_id bigint, text string") -> DataFrame:
    """``seat, guest, doc_id, text`` rows, sorted so that a row's successor in descending id order follows it.

    Ids are cut into ranges; every range also gets the first row of the range
    after it as a guest, and the last range the very first row. Nulls come
    after all ids; rows of one id are ordered by a hash of their text, and an id
    or nulls that fill several ranges are cut by that hash. Only ids are read to
    find the ranges. There are about eight ranges per shuffle task, at most
    twice as many, which bounds the broadcast table of first rows and the window
    over it.
    """
    marked, _ = key_buckets(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id", F.xxhash64("text"))
    order = [F.col("top").desc_nulls_last(), F.col("top_hash").desc()]
    # The row that comes first in descending order; a bucket of nulls has no other ids.
    highest = F.max(F.struct("doc_id", F.xxhash64("text").alias("hash")))
    tops = marked.groupBy("bucket").agg(highest.alias("first")).select("bucket", F.col("first.doc_id").alias("top"), F.col("first.hash").alias("top_hash"))
    every = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    host = F.coalesce(F.lag("bucket").over(Window.orderBy(*order)), F.last("bucket").over(every))
    hosts = F.broadcast(tops.select(F.col("bucket").alias("of"), "top", "top_hash", host.alias("host")))
    first = (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top")) & (F.xxhash64("text") == F.col("top_hash"))
    own = F.struct(F.col("bucket").alias("seat"), F.lit(0).alias("guest"))
    visit = F.struct(F.col("host").alias("seat"), F.lit(1).alias("guest"))
    seats = F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, visit))
    seated = marked.join(hosts, first, "left").select(
        F.explode(seats).alias("at"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    ).select("at.seat", "at.guest", "doc_id", "text")
    return seated.repartition(tasks(docs.sparkSession), "seat").sortWithinPartitions(
        "seat", "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()
    )


_COMPARED = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def compared(docs: DataFrame, words: int = WORDS, permutations: int = PERMUTATIONS) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses.

    One row per row of ``docs``; a single row is its own successor.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(words, permutations)

        def row(one, two) -> tuple:
            doc, text, print_ = one
            edited = edited_text(text, two[1])
            other = hasher.of(edited)
            digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            return (doc, len(text), digest, print_.tobytes(), other.tobytes(), likeness(print_, other), likeness(print_, two[2]))

        # The row that waits for its successor, and whether its range is done.
        waiting, seat = None, None
        for batch in batches:
            rows = []
            for at, guest, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != seat:
                    waiting, seat = None, at
                elif waiting is None:
                    continue
                here = (doc, text, hasher.of(text))
                if waiting is not None:
                    rows.append(row(waiting, here))
                waiting = None if guest else here
            columns = zip(*rows, strict=True) if rows else [[] for _ in _COMPARED]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COMPARED, strict=True)], schema=_COMPARED)

    return beside_next(docs).mapInArrow(
        compare,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double",
    )


def near_pairs(docs: DataFrame, similar: float = SIMILAR, words: int = WORDS, bands: int = BANDS, slack: float = 0.1) -> DataFrame:
    """``(a, b, jaccard)``: links between distinct texts, given by hash, that are ``similar`` or more.

    Signature bands meet in buckets, and pairs of an estimated likeness of
    ``similar - slack`` or more join their texts to candidate groups. Inside a
    group every pair is decided by its exact Jaccard similarity
    (:func:`linked`), so the links join the same texts as all such pairs do, in
    fewer rows. Use :func:`corvane.llm.components.components` for groups.
    """
    hasher = Hasher(words)
    width = 8 + 2 * PERMUTATIONS

    @pandas_udf("binary")
    def signature(texts: pd.Series) -> pd.Series:
        return pd.Series([hasher.of(t).tobytes() for t in texts], dtype=object)

    @pandas_udf("array<bigint>")
    def slots(prints: pd.Series) -> pd.Series:
        size = 2 * PERMUTATIONS // bands
        return pd.Series([
            [int.from_bytes(hashlib.blake2b(p[i * size : (i + 1) * size], digest_size=8, salt=i.to_bytes(2)).digest(), signed=True)
             for i in range(bands)] for p in prints
        ], dtype=object)

    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    prints = stored(docs.withColumn("h", text_hash).select("h", signature("text").alias("fp")), "minhash")
    classes = prints.groupBy("h").agg(F.min("fp").alias("fp"))
    item = F.concat(F.unhex(F.lpad(F.hex("h"), 16, "0")), F.col("fp"))
    rows = classes.select(F.explode(slots("fp")).alias("slot"), item.alias("item"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(number: np.ndarray, raw: np.ndarray) -> pa.RecordBatch:
            ids = raw[:, :8].copy().view(">i8").ravel().astype(np.int64)
            prints_ = raw[:, 8:].copy().view("<u2")
            low = buckets.merged(len(raw), *alike(prints_, number, similar - slack))
            b = np.flatnonzero(low != np.arange(len(low)))
            return pa.RecordBatch.from_arrays([pa.array(ids[low[b]]), pa.array(ids[b])], names=["a", "b"])

        return buckets.runs(batches, width, found)

    edges = buckets.met(rows).mapInArrow(link, "a bigint, b bigint").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
    members = components(edges).select(F.col("node").alias("h"), F.col("root").alias("slot"))
    return linked(docs.withColumn("h", text_hash), members, similar, words)


def alike(prints: np.ndarray, number: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs inside each run whose likeness is ``least`` or more."""
    first, second = ([np.zeros(0, dtype=np.int32)] for _ in range(2))
    left = np.arange(len(prints), dtype=np.int32)
    for step in itertools.count(1):
        left = left[left + step < len(prints)]
        left = left[number[left] == number[left + step]]
        if not len(left):
            return np.concatenate(first), np.concatenate(second)
        fits = np.mean(prints[left] == prints[left + step], axis=1) >= least
        first.append(left[fits])
        second.append(left[fits] + np.int32(step))


def linked(docs: DataFrame, members: DataFrame, similar: float, words: int = WORDS) -> DataFrame:
    """``(a, b, jaccard)`` links of ``similar`` or more that join what all such pairs inside a group join.

    ``docs`` has the hash ``h`` of its text, ``members`` the ``slot`` of the
    group of every ``h`` to compare. The shingle sets themselves meet, in
    chunks where a group is large, and every pair of a group is compared unless
    links already found join it. Nothing is discarded before the exact test.
    """
    hasher = Hasher(words)

    @pandas_udf("binary")
    def shingle_set(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(hasher.shingles(t)).astype("<u4").tobytes() for t in texts], dtype=object)

    # Copies are combined inside their tasks before they move: one text may be a third of all rows.
    texts = docs.groupBy("h").agg(F.first("text").alias("text")).join(members, "h")
    item = F.concat(F.unhex(F.lpad(F.hex("h"), 16, "0")), shingle_set("text"))
    sets = stored(texts.select("slot", item.alias("item")), "shingle-sets")
    rows = F.count(F.lit(1))
    chunks = F.greatest(
        F.ceil(rows / buckets.CHUNK), F.ceil(F.sum(F.length("item")) / CHUNK_BYTES),
        # Smaller chunks as long as their pairs are fewer than the tasks.
        F.least(F.ceil(rows / SPREAD_CHUNK), F.lit(math.ceil(math.sqrt(2 * tasks(docs.sparkSession))))),
    )
    large = sets.groupBy("slot").agg(chunks.cast("int").alias("chunks")).filter("chunks > 1")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for items in buckets.groups(batches):
            ids = np.frombuffer(b"".join(i[:8] for i in items), ">i8").astype(np.int64)
            a, b, likeness_ = exact_links([np.frombuffer(i, "<u4", offset=8) for i in items], similar)
            held.append((np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), likeness_))
            size += len(a)
            if size >= LINK_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=["a", "b", "jaccard"])
                held, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=["a", "b", "jaccard"])

    return buckets.met(sets, large=large).mapInArrow(compare, "a bigint, b bigint, jaccard double").distinct()


def exact_links(sets: list[np.ndarray], similar: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of ``similar`` or more and their Jaccard similarities; they join what all such pairs join."""
    sizes = np.array([len(s) for s in sets])
    known, places = np.unique(np.concatenate(sets), return_inverse=True)
    places = np.split(places.astype(np.int32), np.cumsum(sizes)[:-1])
    inside = np.zeros(len(known), dtype=bool)
    tree = np.arange(len(sets))
    first, second, found = ([np.zeros(0, dtype=t)] for t in (np.int64, np.int64, np.float64))
    for one in range(len(sets) - 1):
        rest = np.flatnonzero(tree[one + 1 :] != tree[one]) + one + 1
        # No similarity is above the ratio of the sizes; two empty sets have 1.
        low, high = np.minimum(sizes[rest], sizes[one]), np.maximum(sizes[rest], sizes[one])
        rest = rest[np.where(high > 0, low / np.maximum(1, high), 1.0) >= similar]
        if not len(rest):
            continue
        inside[places[one]] = True
        common = np.concatenate([[0], np.cumsum(inside[np.concatenate([places[r] for r in rest])])])
        inside[places[one]] = False
        ends = np.cumsum(sizes[rest])
        both = common[ends] - common[ends - sizes[rest]]
        either = sizes[rest] + sizes[one] - both
        jaccard = np.where(either > 0, both / np.maximum(1, either), 1.0)
        fits = np.flatnonzero(jaccard >= similar)
        # One link to every tree is enough.
        fits = fits[np.unique(tree[rest[fits]], return_index=True)[1]]
        first.append(np.full(len(fits), one))
        second.append(rest[fits])
        found.append(jaccard[fits])
        tree[np.isin(tree, tree[rest[fits]])] = tree[one]
    return np.concatenate(first), np.concatenate(second), np.concatenate(found)
