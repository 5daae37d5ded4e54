"""Phrase collocations by top-order marginalisation.

Texts (A-Z as a-z) fall into pieces at ``. , ; : ! ?`` and line breaks, pieces
into words at blanks and tabs. Every word opens one window of ``order`` lead
columns ``w1 .. wN``, padded with nulls where its piece ends. Only these longest
windows are counted; Spark's ROLLUP sums the counts of successively shorter
prefixes. A phrase of k words occurs where a window starts with it, so the level
of k columns is its exact count, and no n-gram is exploded for each length.

No phrase is more frequent than the word pairs in it. A first pass counts words,
and pairs by a 64-bit hash; pairs that reach the least count go into a bit filter
of at most ``MOST_BITS`` bits, the only thing that is broadcast. The second pass
opens windows inside runs of words whose pairs pass. The filter never loses a
frequent pair; a pair that passes by chance costs rows, not results, for every
level is cut at its exact count.

Null texts count as empty, null languages as ``und``. Ids are not read, so
repeated rows count as often as they stand there. An empty table gives no rows.
A very long text is held once in a task with its words; a long word is copied
into a window only if its pairs are frequent. Columns other than ``text`` and
``lang`` are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import compress, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import stored, tasks

ORDER = 5
LEAST = 100
MOST = 2000
#: Words that a task holds as objects at a time, words it counts before it passes counts on, rows of a batch it passes on,
#: hashes it keeps, and the size of the pair filter.
TOKENS = 1 << 17
COUNTED = 1 << 20
ROWS = 1 << 16
KEPT_HASHES = 1 << 16
MOST_BITS = 27
BITS_PER_PAIR = 16

_BREAK = b"\n"
_MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
_PRIME = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F)]

_COUNTED = pa.schema([("lang", pa.string()), ("word", pa.string()), ("pair", pa.int64()), ("n", pa.int64())])
_RUNS = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string()))])


def words_of(text: bytes | None) -> list[bytes]:
    """Words in order, and a line break after every piece."""
    pieces = (text or b"").lower().translate(_MARKS).replace(b"\n", b" \n ")
    return [*filter(None, pieces.split(b" ")), _BREAK]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KEPT_HASHES:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def pair_hashes(words: list[bytes], lang: str, hashes: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word with the word after it, and which of them lie inside a piece."""
    single = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    inside = np.fromiter(map(_BREAK.__ne__, words), bool, len(words))
    salt = np.uint64(hashes[b"\n" + lang.encode("utf-8", "surrogatepass")])
    mixed = (single[:-1] + salt) * _PRIME[0]
    mixed ^= mixed >> np.uint64(29)
    mixed = (mixed + single[1:]) * _PRIME[1]
    mixed ^= mixed >> np.uint64(32)
    return mixed, inside[:-1] & inside[1:]


def by_language(batches: Iterator[pa.RecordBatch], most: int = TOKENS) -> Iterator[tuple[str, list[bytes]]]:
    """Words of whole texts of one language, about ``most`` at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
        for lang, text in zip(langs, texts, strict=True):
            words = words_of(text.as_py())
            held.setdefault(lang, []).extend(words)
            size += len(words)
            if size >= most:
                while held:
                    yield held.popitem()
                size = 0
    yield from held.items()


def _batch(lang: str, words: list[bytes] | None, pairs: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    word = pa.nulls(len(n), pa.string()) if words is None else pa.array(words, pa.binary()).cast(pa.string())
    pair = pa.nulls(len(n), pa.int64()) if pairs is None else pa.array(pairs.view(np.int64))
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(n)), word, pair, pa.array(n, pa.int64())], schema=_COUNTED)


def count_batches(batches: Iterator[pa.RecordBatch], most: int = COUNTED) -> Iterator[pa.RecordBatch]:
    """Counts of every ``most`` words. Only distinct words are held meanwhile, and eight bytes for each pair."""
    hashes = _Hashes()
    held: dict[str, tuple[Counter, list[np.ndarray]]] = {}
    size = 0

    def passed_on() -> Iterator[pa.RecordBatch]:
        while held:
            lang, (single, mixed) = held.popitem()
            yield _batch(lang, None, None, np.array([single.total()]))
            some = iter(single.items())
            while part := list(islice(some, ROWS)):
                yield _batch(lang, [w for w, _ in part], None, np.array([n for _, n in part]))
            del single
            pairs, times = np.unique(np.concatenate(mixed), return_counts=True)
            mixed.clear()
            for at in range(0, len(pairs), ROWS):
                yield _batch(lang, None, pairs[at : at + ROWS], times[at : at + ROWS])

    for lang, words in by_language(batches):
        single, pairs = held.setdefault(lang, (Counter(), []))
        single.update(words)
        del single[_BREAK]
        mixed, inside = pair_hashes(words, lang, hashes)
        pairs.append(mixed[inside])
        size += len(words)
        if size >= most:
            yield from passed_on()
            size = 0
    yield from passed_on()


def counted(docs: DataFrame) -> DataFrame:
    """``lang, word, pair, n``: occurrences by language (word and pair null), by word, and by hash of a pair (word null)."""
    found = _texts(docs).mapInArrow(count_batches, "lang string, word string, pair bigint, n bigint")
    return found.groupBy("lang", "word", "pair").agg(F.sum("n").alias("n"))


def pair_filter(pairs: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bit set over hashes: two bits for each ``pair``, in a power of two of bits, at most ``2 ** most_bits``.

    The bits are set by Spark, 64 to a row, so no more than ``2 ** (most_bits - 6)`` rows come to the driver.
    """
    bits = min(most_bits, max(10, (pairs.count() * BITS_PER_PAIR).bit_length()))
    low = (1 << bits) - 1
    places = F.array(F.col("pair").bitwiseAND(low), F.shiftrightunsigned("pair", bits).bitwiseAND(low))
    words = pairs.select(F.explode(places).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(63).cast("int"))).alias("set")
    )
    found = words.toPandas()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[found["word"].to_numpy(dtype=np.int64)] = found["set"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def passes(mixed: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    """Which hashes have both bits in the filter."""
    low, shift = np.uint64(len(filter_) * 64 - 1), np.uint64((len(filter_) * 64).bit_length() - 1)
    found = np.ones(len(mixed), dtype=bool)
    for at in (mixed & low, (mixed >> shift) & low):
        found &= (filter_[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def runs(docs: DataFrame, filter_: np.ndarray) -> DataFrame:
    """``lang, words``: longest runs of two words or more of a piece whose pairs all pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run_batches(batches, shared.value)

    return _texts(docs).mapInArrow(cut, "lang string, words array<string>")


def run_batches(batches: Iterator[pa.RecordBatch], filter_: np.ndarray) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for lang, words in by_language(batches):
        mixed, inside = pair_hashes(words, lang, hashes)
        good = np.concatenate([[False], inside & passes(mixed, filter_), [False]])
        # A word is in a run if the pair before or after it is good, and opens one if only the pair after it is.
        member = good[:-1] | good[1:]
        starts = np.flatnonzero((~good[:-1] & good[1:])[member])
        flat = list(compress(words, member.tolist()))
        for at in range(0, len(starts), ROWS):
            ends = np.append(starts, len(flat))[at : at + ROWS + 1]
            values = pa.array(flat[ends[0] : ends[-1]], pa.binary()).cast(pa.string())
            lists = pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(lists)), lists], schema=_RUNS)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def windows(found: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, w1 .. wN``: for every word of ``words`` the words from it on, nulls past the last."""
    lead = [F.slice("words", F.lit(k + 1), F.greatest(F.size("words") - k, F.lit(0))) for k in range(order)]
    zipped = F.arrays_zip(*[c.alias(f"w{k + 1}") for k, c in enumerate(lead)])
    return found.select("lang", F.inline(zipped)).toDF("lang", *[f"w{k + 1}" for k in range(order)])


def prefix_counts(longest: DataFrame, least: int = LEAST, order: int = ORDER) -> DataFrame:
    """``lang, k, phrase, a``: phrases of two words or more that occur ``least`` times, from windows of ``order`` columns."""
    names = [f"w{k + 1}" for k in range(order)]
    top = longest.groupBy("lang", *names).agg(F.count(F.lit(1)).alias("n"))
    summed = top.rollup("lang", *names).agg(F.sum("n").alias("a"), F.grouping_id().alias("rolled"))
    # Every column rolled up sets one more of the low bits.
    k = order - F.bit_count("rolled").cast("int")
    # Padding is a null in a column that is not rolled up.
    whole = F.array_size(F.array_compact(F.array(*names))) == F.col("k")
    return summed.withColumn("k", k).filter((F.col("k") >= 2) & (F.col("a") >= least) & whole).select(
        "lang", "k", F.concat_ws(" ", *names).alias("phrase"), "a"
    )


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """``floor(1000 * a * n / (left * right))``; the products are exact decimals of 38 places."""
    wide = lambda c, places: c.cast(f"decimal({places},0)")
    up, down = F.lit(1000).cast("decimal(4,0)") * wide(a, 17) * wide(n, 16), wide(left, 18) * wide(right, 18)
    return F.call_function("div", up, down).cast("bigint")


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, order: int = ORDER) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``most`` best phrases of every language.

    A candidate has two to ``order`` words and occurs ``least`` times. Cut after
    its first words it scores ``1000 * a * n / (l * r)``, rounded down; its
    lowest score counts, the earliest cut on ties. Candidates that a longer one
    holds and that never occur without it are dropped.
    """
    total = F.col("word").isNull() & F.col("pair").isNull()
    counts = stored(counted(docs).filter(total | (F.col("n") >= least)), "collocation-counts")
    pairs = counts.filter(F.col("pair").isNotNull()).select("pair")
    words = counts.filter(F.col("word").isNotNull()).select("lang", F.col("word").alias("part"), F.col("n").alias("f"))
    totals = counts.filter(total).select("lang", "n")
    longest = windows(runs(docs, pair_filter(pairs)), order)
    phrases = stored(prefix_counts(longest, least, order), "collocation-phrases")
    parts = words.union(phrases.select("lang", "phrase", "a"))

    cuts = phrases.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    first = F.call_function("substring_index", F.col("phrase"), F.lit(" "), F.col("cut"))
    rest = F.call_function("substring_index", F.col("phrase"), F.lit(" "), F.col("cut") - F.col("k"))
    joined = (
        cuts.withColumns({"first": first, "rest": rest})
        .join(parts.withColumnsRenamed({"part": "first", "f": "l"}), ["lang", "first"])
        .join(parts.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    )
    scored = joined.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best")).select(
        "lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score"
    )
    # A phrase that any longer one always holds is always held by one that is a single word longer.
    held = phrases.filter("k > 2").select("lang", "a", F.explode(F.array(
        F.call_function("substring_index", F.col("phrase"), F.lit(" "), F.col("k") - 1),
        F.call_function("substring_index", F.col("phrase"), F.lit(" "), 1 - F.col("k")),
    )).alias("phrase"))
    left = scored.join(held, ["lang", "phrase", "a"], "left_anti")
    return best(left, most)


def best(found: DataFrame, most: int) -> DataFrame:
    """Ranks by language; a first cut in hash buckets leaves ``most`` rows of each, whatever a language holds."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(tasks(found.sparkSession)))
    inside = Window.partitionBy("lang", "bucket").orderBy(*order)
    short = found.withColumn("bucket", bucket).withColumn("place", F.row_number().over(inside)).filter(F.col("place") <= most)
    ranked = short.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
