import json
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.session import scratch_path, shared_folder
from corvane.sources import binary_points, files, models, text_io


def test_points_text(spark, tmp_path, rows):
    (tmp_path / "p.txt").write_text("7 1.0,2.0\n\n8\t3.0 4.0\n")
    got = rows(text_io.read_points(spark, str(tmp_path / "p.txt")))
    assert got == [("7", [1.0, 2.0]), ("8", [3.0, 4.0])]


def test_several_inputs(spark, tmp_path, rows):
    (tmp_path / "a.txt").write_text("x\n")
    (tmp_path / "b.txt").write_text("y\nz\n")
    assert rows(text_io.read_lines(spark, str(tmp_path / "a.txt"), str(tmp_path / "b.txt"))) == [("x",), ("y",), ("z",)]


def test_vector_parsers(spark):
    row = spark.range(1).select(
        text_io.csv_vector(F.lit("1.5,-2")).alias("c"),
        text_io.bracketed_vector(text_io.tsv_field(F.lit("666\turl\t[1.0, 2e-05]"), 2)).alias("t"),
    ).first()
    assert row["c"] == [1.5, -2.0] and row["t"] == [1.0, 2e-05]


def test_centre_and_membership_files(spark, tmp_path):
    centres = spark.createDataFrame([(1, [0.5, 2.0]), (0, [1 / 3, -1.0])], "cid int, m array<double>")
    text_io.write_centres(centres, str(tmp_path / "c"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "c")).orderBy("value").collect()]
    assert lines == ["0 0.333333 -1.000000", "1 0.500000 2.000000"]
    text_io.write_membership(spark.createDataFrame([(5, 1)], "id bigint, cid int"), str(tmp_path / "m"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "m")).collect()] == ["5 1"]


def test_pair_sink_replaces(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    text_io.write_pairs(spark.createDataFrame([("a", 1)], "k string, v int"), path)
    text_io.write_pairs(spark.createDataFrame([('b "c"', 2), ("", 3)], "k string, v int"), path)
    assert rows(text_io.read_pairs(spark, path, "k string, v int")) == [("", 3), ('b "c"', 2)]
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["\t3", 'b "c"\t2']


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.bin").write_bytes(b"123")
    (tmp_path / "b.txt").write_bytes(b"4")
    (tmp_path / ".hidden.bin").write_bytes(b"5")
    (tmp_path / "sub" / "c.bin").write_bytes(b"67")
    flat = files.file_inventory(spark, str(tmp_path), r".*\.bin")
    deep = files.file_inventory(spark, str(tmp_path), r".*\.bin", recursive=True)
    assert [tuple(r) for r in flat.select("name", "length").collect()] == [("a.bin", 3)]
    assert sorted(r["name"] for r in deep.collect()) == ["a.bin", "c.bin"]
    assert tuple(files.total_size(deep).first()) == (2, 5)
    assert [r["folder"] for r in files.child_folders(deep, str(tmp_path)).collect()] == ["sub"]
    # The pattern has to match the whole path.
    assert files.file_inventory(spark, str(tmp_path), r"a\.bin").count() == 0


def test_binary_points_are_read_in_row_ranges(spark, tmp_path):
    array = np.arange(70, dtype="<f4").reshape(10, 7)
    path = tmp_path / "p.bin"
    path.write_bytes(np.array([10, 7], "<i4").tobytes() + array.tobytes())
    table = binary_points.read_binary_points(spark, str(path), split_rows=3)
    assert table.rdd.getNumPartitions() == 4
    got = {r["id"]: r["x"] for r in table.collect()}
    assert np.array_equal([got[i] for i in range(10)], array)


def test_binary_points_round_trip_in_many_files(spark, tmp_path):
    rng = np.random.default_rng(0)
    array = rng.random((500, 3)).astype("<f4")
    points = spark.createDataFrame(
        [(i, [float(v) for v in r]) for i, r in enumerate(array)], "id bigint, x array<double>"
    ).repartition(5)
    path = str(tmp_path / "points")
    binary_points.write_binary_points(points, path)
    binary_points.write_binary_points(points, path)
    names = sorted(p.name for p in (tmp_path / "points").iterdir())
    # The second write has replaced the first, and its manifest names what is there.
    listed = [f for f, _, _ in json.loads((tmp_path / "points" / "_manifest").read_text())]
    assert sorted(["_manifest", *listed]) == names
    got = {r["id"]: r["x"] for r in binary_points.read_binary_points(spark, path).collect()}
    assert np.array_equal([got[i] for i in range(500)], array)


def written(folder, arrays):
    folder.mkdir()
    for i, array in enumerate(arrays):
        (folder / f"part-{i:03}.bin").write_bytes(np.array(array.shape, "<i4").tobytes() + array.astype("<f4").tobytes())


def test_a_folder_without_a_manifest_is_planned_by_tasks(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    arrays = [rng.random((n, 4)).astype("<f4") for n in (5, 0, 17, 1, 30)]
    written(tmp_path / "points", arrays)
    (tmp_path / "points" / "_note").write_text("not data")

    def none(*_):
        raise AssertionError("the driver opened a file")

    monkeypatch.setattr(binary_points, "_data_files", none)
    table = binary_points.read_binary_points(spark, str(tmp_path / "points"), split_rows=6)
    got = {r["id"]: r["x"] for r in table.collect()}
    whole = np.concatenate(arrays)
    assert sorted(got) == list(range(len(whole))) and np.array_equal([got[i] for i in range(len(whole))], whole)
    ranges = binary_points.row_ranges(binary_points.file_sizes(spark, str(tmp_path / "points")), 6).collect()
    assert sum(r["rows"] for r in ranges) == len(whole) and max(r["rows"] for r in ranges) == 6


def test_a_cut_file_and_an_empty_folder(spark, tmp_path):
    written(tmp_path / "cut", [np.ones((4, 2))])
    path = tmp_path / "cut" / "part-000.bin"
    path.write_bytes(path.read_bytes()[:-3])
    with pytest.raises(Exception, match="not 4 points"):
        binary_points.read_binary_points(spark, str(tmp_path / "cut")).collect()
    (tmp_path / "empty").mkdir()
    assert binary_points.read_binary_points(spark, str(tmp_path / "empty")).collect() == []
    spark.dataSource.register(binary_points.BinaryPoints)
    with pytest.raises(Exception, match="no manifest"):
        spark.read.format(binary_points.FORMAT).load(str(tmp_path / "cut")).collect()


def test_vector_tables(spark, tmp_path, rows):
    table = spark.createDataFrame([(1, [1.0])], "cid int, m array<double>")
    models.save_vectors(table, str(tmp_path / "v"))
    assert rows(models.load_vectors(spark, str(tmp_path / "v"))) == [(1, [1.0])]


def test_scratch_paths_share_one_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    folder = shared_folder(spark)
    assert first.startswith(folder.rstrip("/")) and second.startswith(folder.rstrip("/"))


def test_scratch_goes_to_the_folder_the_cluster_names(tmp_path):
    code = (
        "import sys; from corvane.session import build_session, scratch_path, frozen\n"
        "s = build_session('t', 'local[1]', spark__ui__enabled='false', spark__checkpoint__dir=sys.argv[1])\n"
        "assert scratch_path(s, 'x').startswith(sys.argv[1])\n"
        "assert frozen(s.range(3)).count() == 3\n"
    )
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code, str(tmp_path)], check=True, cwd=root, timeout=120)
    assert any(tmp_path.rglob("rdd-*"))


def test_wrong_widths_are_refused(spark, tmp_path):
    table = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id bigint, x array<double>").coalesce(1)
    with pytest.raises(Exception):
        binary_points.write_binary_points(table, str(tmp_path / "bad"))
