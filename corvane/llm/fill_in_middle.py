"""Texts rearranged for filling in the middle, cut at code points.

Two cuts between code points are drawn from a SHA-256 of seed and id; what lies
before, between and after them is prefix, middle and suffix. ``psm`` puts
markers and parts in the order prefix, suffix, middle, ``spm`` in the order
suffix, prefix, middle. Texts that are empty or hold a marker, and a drawn share
of all others, stay ``plain``.

Cut offsets in bytes come from a :class:`corvane.llm.boundary_set.BoundarySet`
of the text; its form is never decoded to wide characters, so a text costs its
UTF-8 bytes, a container at a time, and its output.

Null texts count as empty, a null id as the empty text in the hash. Rows stand
for themselves: repeated ids and texts give repeated rows. An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.boundary_set import BoundarySet

SEED = 1
#: Of a hundred texts, those left plain, and of the others those with the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_FORMED = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("output", pa.string()),
])
_FORMED_DDL = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
_DIGESTS = pa.schema([*list(_FORMED)[:5], ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_DIGESTS_DDL = _FORMED_DDL.replace("output string", "output_sha256 string, restored_sha256 string")


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits from seed and id."""
    raw = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(raw[i : i + 4], "big") for i in range(0, 16, 4)]


def formed(doc_id: int | None, raw: bytes) -> tuple[int, str, int | None, int | None, bytes]:
    """``(n, form, prefix_chars, middle_chars, output)`` of UTF-8 text; ``n`` in code points."""
    boundaries = BoundarySet.of_text(raw)
    n = len(boundaries) - 1
    one, two, keep, turn = draws(doc_id)
    if not n or any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)) or keep % 100 >= 100 - PLAIN:
        return n, "plain", None, None, raw
    low, high = sorted((one % (n + 1), two % (n + 1)))
    start, stop = boundaries.select(low), boundaries.select(high)
    prefix, middle, suffix = raw[:start], raw[start:stop], raw[stop:]
    if turn % 100 < SUFFIX_FIRST:
        return n, "spm", low, high - low, b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    return n, "psm", low, high - low, b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])


def restored(output: bytes, form: str) -> bytes:
    """The text of an output; no part holds a marker, so each is found where it was put."""
    if form == "plain":
        return output
    marker = SUFFIX if form == "psm" else PREFIX
    first, rest = output[len(marker) :].split(marker, 1)
    second, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (first, second) if form == "psm" else (second, first)
    return prefix + middle + suffix


def transformed(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _formed(batches):
            *columns, output = [list(c) for c in zip(*found, strict=True)]
            arrays = [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(_FORMED)[1:5], strict=True))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(output, pa.binary()).cast(pa.string())], schema=_FORMED)

    return _texts(docs).mapInArrow(rows, _FORMED_DDL)


def digests(docs: DataFrame) -> DataFrame:
    """As :func:`transformed`, with digests of the output and of the text rebuilt from it in place of the output."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _formed(batches):
            summed = [
                (n, form, low, middle, hashlib.sha256(out).hexdigest(), hashlib.sha256(restored(out, form)).hexdigest())
                for n, form, low, middle, out in found
            ]
            columns = zip(zip(*summed, strict=True), list(_DIGESTS)[1:], strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in columns)], schema=_DIGESTS)

    return _texts(docs).mapInArrow(rows, _DIGESTS_DDL)


#: Rows whose outputs are held together.
_ROWS = 256


def _formed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            texts = batch.column(1).cast(pa.binary())
            yield batch, [formed(d, t.as_py() or b"") for d, t in zip(batch.column(0).to_pylist(), texts, strict=True)]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
