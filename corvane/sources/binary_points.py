"""Raw binary points: ``int32 n, int32 d`` and ``n * d`` little-endian float32.

Format name ``binary_points``; a path is one file or a folder of such files.
Rows read as ``(id, x)``, numbered across the files in name order. A folder
written here also holds ``_manifest``: its files in order, with their sizes. The
manifest is what commits a write, and readers need to open no file to plan. A
folder from elsewhere has none: Spark then lists its files, tasks read their
headers, and row numbers are running sums over the files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from corvane.operators import ranking
from corvane.operators.nearest import batch_matrix

HEADER = np.dtype("<i4")
VALUE = np.dtype("<f4")
SCHEMA = "id bigint, x array<float>"
FORMAT = "binary_points"
# Rows per read task and bytes per written file.
SPLIT_ROWS = 1 << 20
FILE_BYTES = 128 << 20
READ_ROWS = 8192
MANIFEST = "_manifest"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _data_files(path: str) -> list[str]:
    store, where = _open(path)
    if store.get_file_info(where).type == fs.FileType.File:
        return [where]
    found = store.get_file_info(fs.FileSelector(where))
    names = [i.path for i in found if i.type == fs.FileType.File and i.base_name[0] not in "._"]
    return sorted(names)


def _manifest(path: str) -> list[tuple[str, int, int]] | None:
    """``(file, rows, width)`` as the last committed write left them; None without a manifest."""
    store, where = _open(path)
    name = f"{where.rstrip('/')}/{MANIFEST}"
    if store.get_file_info(name).type != fs.FileType.File:
        return None
    with store.open_input_file(name) as source:
        return [(f"{path.rstrip('/')}/{f}", n, d) for f, n, d in json.loads(source.read())]


def _header(path: str) -> tuple[int, int]:
    """``(rows, width)`` of a file."""
    store, name = _open(path)
    with store.open_input_file(name) as source:
        rows, width = np.frombuffer(source.read(2 * HEADER.itemsize), HEADER).tolist()
    return rows, width


def _sizes(path: str) -> list[tuple[str, int, int]]:
    """``(file, rows, width)`` in order, from the manifest or the header of a single file."""
    known = _manifest(path)
    if known is not None:
        return known
    store, where = _open(path)
    if store.get_file_info(where).type != fs.FileType.File:
        raise ValueError(f"{path} has no manifest: read it with read_binary_points")
    return [(path, *_header(path))]


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(file, n, width)`` of the files of a folder, their headers read by tasks; a file of another length than its header says raises."""

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lengths = (c.to_pylist() for c in batch.columns)
            found = [_header(name) for name in names]
            for name, length, (n, width) in zip(names, lengths, found, strict=True):
                if length != 2 * HEADER.itemsize + n * width * VALUE.itemsize:
                    raise ValueError(f"{name} holds {length} bytes, not {n} points of {width} coordinates")
            sizes = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(names), *sizes], names=["file", "n", "width"])

    # Only names and lengths are asked for, so no content is read here.
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return listed.repartition(tasks, "path").mapInArrow(headers, "file string, n bigint, width bigint")


def row_ranges(sizes: DataFrame, split_rows: int) -> DataFrame:
    """``(file, first_id, row, rows, width)``: pieces of at most ``split_rows`` rows, numbered across the files in name order."""
    placed = ranking.running_total(sizes.filter(F.col("n") > 0), [F.col("file")], "n", "earlier")
    cut = placed.withColumn("row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(split_rows).cast("bigint"))))
    return cut.select(
        "file", (F.col("earlier") + F.col("row")).alias("first_id"), "row",
        F.least(F.lit(split_rows), F.col("n") - F.col("row")).alias("rows"), "width",
    )


@dataclass
class RowRange(InputPartition):
    file: str
    first_id: int
    row: int
    rows: int
    width: int


class PointsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split_rows = int(options.get("splitrows", SPLIT_ROWS))

    def partitions(self) -> list[RowRange]:
        out, before = [], 0
        for name, n, width in _sizes(self.path):
            for row in range(0, n, self.split_rows):
                out.append(RowRange(name, before + row, row, min(self.split_rows, n - row), width))
            before += n
        return out

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        return _rows(partition)


def _rows(piece: RowRange) -> Iterator[pa.RecordBatch]:
    store, name = _open(piece.file)
    line = piece.width * VALUE.itemsize
    with store.open_input_file(name) as source:
        source.seek(2 * HEADER.itemsize + line * piece.row)
        for at in range(0, piece.rows, READ_ROWS):
            rows = min(READ_ROWS, piece.rows - at)
            flat = np.frombuffer(source.read(rows * line), VALUE)
            ids = np.arange(rows, dtype=np.int64) + piece.first_id + at
            ends = pa.array(np.arange(rows + 1, dtype=np.int32) * piece.width)
            x = pa.ListArray.from_arrays(ends, pa.array(flat, pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array(ids), x], names=["id", "x"])


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: list[tuple[str, int, int]]


class PointsWriter(DataSourceArrowWriter):
    """Each task writes files of bounded size into a hidden folder; the commit
    moves those of the successful attempts beside the old ones, then replaces
    the manifest, then deletes the old files. A failure at any point leaves
    either the old points or the new ones readable."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.overwrite = overwrite
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        context = TaskContext.get()
        store, where = _open(self.path)
        stem = f"part-{context.partitionId():06d}"
        folder = f"{where}/_pending/{context.taskAttemptId()}"
        store.create_dir(folder, recursive=True)
        names, held, width, size = [], [], 0, 0

        def flush() -> None:
            name = f"{stem}-{len(names):06d}.bin"
            block = np.concatenate(held)
            with store.open_output_stream(f"{folder}/{name}") as sink:
                sink.write(np.array(block.shape, HEADER).tobytes())
                sink.write(block.tobytes())
            names.append((f"{folder}/{name}", *block.shape))
            held.clear()

        for batch in iterator:
            if not batch.num_rows:
                continue
            column = batch.column(batch.schema.get_field_index("x"))
            block = batch_matrix(column).astype(VALUE)
            width = width or block.shape[1]
            if block.shape[1] != width:
                raise ValueError("all points need the same number of coordinates")
            held.append(block)
            size += block.nbytes
            if size >= self.file_bytes:
                flush()
                size = 0
        if held:
            flush()
        return WrittenFiles(names)

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        store, where = _open(self.path)
        old = _data_files(self.path)
        if old and not self.overwrite:
            raise ValueError(f"{self.path} already holds points; write with mode('overwrite')")
        run = uuid.uuid4().hex[:12]
        kept = []
        for name, rows, width in sorted(f for m in messages if m for f in m.files):
            own = f"{name.rsplit('/', 1)[1].removesuffix('.bin')}-{run}.bin"
            store.move(name, f"{where}/{own}")
            kept.append((own, rows, width))
        kept.sort()
        with store.open_output_stream(f"{where}/{MANIFEST}-{run}") as sink:
            sink.write(json.dumps(kept).encode())
        store.move(f"{where}/{MANIFEST}-{run}", f"{where}/{MANIFEST}")
        for name in old:
            store.delete_file(name)
        self._drop_pending()

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        self._drop_pending()

    def _drop_pending(self) -> None:
        store, where = _open(self.path)
        if store.get_file_info(f"{where}/_pending").type == fs.FileType.Directory:
            store.delete_dir(f"{where}/_pending")


class BinaryPoints(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PointsReader:
        return PointsReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> PointsWriter:
        return PointsWriter(dict(self.options), overwrite)


def read_binary_points(spark: SparkSession, path: str, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``(id, x)`` of a file or a folder; the driver opens a manifest or a single file's header, and nothing else."""
    store, where = _open(path)
    if store.get_file_info(where).type == fs.FileType.File or _manifest(path) is not None:
        spark.dataSource.register(BinaryPoints)
        return spark.read.format(FORMAT).option("splitrows", split_rows).load(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                yield from _rows(RowRange(**piece))

    pieces = row_ranges(file_sizes(spark, path), split_rows)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(tasks, "file", "row").mapInArrow(read, SCHEMA)


def write_binary_points(points: DataFrame, path: str, order: str = "id") -> None:
    """Writes ``x`` in order of ``order``, so that row numbers follow it."""
    points.sparkSession.dataSource.register(BinaryPoints)
    ordered = points.orderBy(order).select(F.col(order).cast("bigint").alias("id"), F.col("x").cast("array<float>"))
    ordered.write.format(FORMAT).mode("overwrite").save(path)
