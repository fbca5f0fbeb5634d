"""Cutting a CSV file anywhere gives the rows that one task reads from it whole."""

import random

import pytest

from meterlake.sources import csv_exports as C

HEADER = ",".join(c.strip().split()[0] for c in C.ACTIVITY_CSV.split(","))
CELLS = ["", "x", '"a ""b"" c"', '"two\nlines"', '"\n"', '"\n\n"""', '"comma, and ""quote""\n,"', '""', '"crlf\r\nin a cell"', "é日本", '"""\n"""', "{'k': None}"]


def write(path, rows, end="\n", tail=""):
    path.write_bytes((HEADER + end + end.join(",".join(r) for r in rows) + end + tail).encode())
    return str(path)


def whole(spark, paths):
    return sorted(map(tuple, C._read_csv(spark, paths, C.ACTIVITY_CSV).collect()), key=str)


@pytest.fixture()
def cut(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def at(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield at
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_cut(spark, tmp_path, cut, end):
    rng = random.Random(4)
    cells = [c for c in CELLS if end == "\n" or c != '"crlf\r\nin a cell"']
    path = write(tmp_path / "a.csv", [[rng.choice(cells) for _ in range(9)] for _ in range(8)], end)
    want = whole(spark, path)
    sizes = range(7, 97, 9) if end == "\n" else (11, 64)
    for size in sizes:
        cut(size)
        lines = spark.read.text(path).rdd.getNumPartitions()
        assert lines > 3
        assert sorted(map(tuple, C.read_activity_csv(spark, path).collect()), key=str) == want, size


def test_files_of_all_kinds(spark, tmp_path, cut):
    rng = random.Random(5)
    for name, n in (("a", 30), ("b", 0), ("c", 1)):
        write(tmp_path / f"{name}.csv", [[rng.choice(CELLS) for _ in range(9)] for _ in range(n)], tail="\n\n" if name == "a" else "")
    write(tmp_path / "d.csv", [['"' + "line\n" * 400 + '"', *["x"] * 8]])
    want = whole(spark, str(tmp_path))
    cut(50)
    assert sorted(map(tuple, C.read_activity_csv(spark, str(tmp_path)).collect()), key=str) == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path, cut):
    path = write(tmp_path / "a.csv", [[str(i), '"two\nlines"', *["x"] * 7] for i in range(3000)])
    cut(4096)
    df = C.read_activity_csv(spark, path)
    assert df.count() == 3000 and spark.read.text(path).rdd.getNumPartitions() > 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "multiLine" not in plan and "BatchEvalPython" not in plan


def test_broken_rows_fail(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed"):
        C.read_activity_csv(spark, write(tmp_path / "a.csv", [["x"] * 3])).collect()
