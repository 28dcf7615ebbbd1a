"""Row positions: line numbers, samples by position and headers by place, whatever the splits."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from statforge.operators.order import sample_k
from statforge.sources import numbered_lines, numbered_rows, read_lines, read_table

SF = "/root/testdata/sf0.001"


def _files(folder: str, files: dict[str, list[str]], last_newline: bool = True) -> str:
    for name, rows in files.items():
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write("\n".join(rows) + ("\n" if last_newline and rows else ""))
    return folder


@pytest.fixture()
def split_at(spark):
    """Set the size of splits; several files share a task as long as they fit."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def put(size: int) -> None:
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield put
    for k, v in before.items():
        spark.conf.set(k, v)


def _content(rng, n):
    return [rng.choice(["", "x", "héé", "some words " * rng.randrange(9)]) for _ in range(n)]


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_line_numbers_on_any_split(spark, workdir, split_at, size):
    rng = random.Random(size)
    files = {"a.txt": _content(rng, 40), "sub dir/b.txt": _content(rng, 1), "c.txt": [], "d.txt": _content(rng, 75)}
    path = _files(workdir, files, last_newline=size != 64)
    split_at(size)
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    got = sorted((r["file"], r["line_no"], r["value"]) for r in numbered_lines(lines).collect())
    want = []
    for name, rows in files.items():
        rows = rows[:-1] if rows and size == 64 and rows[-1] == "" else rows  # without its end an empty last line is none
        want += [(name.replace(" ", "%20"), i, v) for i, v in enumerate(rows)]
    assert got == sorted(want)


def test_one_file_is_named_without_its_folder(spark, workdir):
    path = _files(workdir, {"x/y/one.txt": ["a", "b"]})
    assert sorted(tuple(r) for r in read_lines(spark, f"{path}/x/y/one.txt", position=True).collect()) == [("a", "one.txt", 0), ("b", "one.txt", 1)]
    assert read_lines(spark, _files(workdir, {"none.txt": []}) + "/none.txt", position=True).collect() == []


def test_table_rows_have_the_place_that_the_file_gives_them(spark, split_at):
    import pyarrow.parquet as pq

    split_at(4096)
    want = pq.read_table(f"{SF}/orders.parquet")["o_orderkey"].to_pylist()
    got = read_table(spark, SF, "orders", position=True).orderBy("line_no").select("file", "line_no", "o_orderkey").collect()
    assert [(r["file"], r["line_no"]) for r in got] == [("orders.parquet", i) for i in range(len(want))]
    assert [r["o_orderkey"] for r in got] == want


def test_sample_is_the_same_on_any_split(spark, workdir, split_at):
    path = _files(workdir, {f"{i}.txt": [f"{i}-{j}" for j in range(200)] for i in range(4)})
    found = []
    for size in (50, 700, 1 << 20):
        split_at(size)
        found.append([sorted(r["value"] for r in sample_k(read_lines(spark, path, position=True), 12, seed).collect()) for seed in range(3)])
    assert found[0] == found[1] == found[2]
    assert len({tuple(x) for x in found[0]}) == 3 and all(len(x) == 12 for x in found[0])


def test_sample_does_not_hang_on_the_folder(spark, workdir):
    rows = {"a.txt": [f"a{i}" for i in range(50)], "b.txt": [f"b{i}" for i in range(50)]}
    one, two = (_files(os.path.join(workdir, d), rows) for d in ("here", "there/below"))
    picked = [sorted(r["value"] for r in sample_k(read_lines(spark, p, position=True), 5).collect()) for p in (one, two)]
    assert picked[0] == picked[1]


@pytest.mark.parametrize("position", [True, False])
def test_a_line_of_six_tenths_is_drawn_as_often_as_it_stands_there(spark, workdir, position):
    rng = random.Random(1)
    rows = ["the same line"] * 600 + [f"other {i}" for i in range(400)]
    rng.shuffle(rows)
    lines = read_lines(spark, _files(workdir, {"rows.txt": rows}), position=position)
    lines = lines.repartition(3).cache() if position else lines.coalesce(1)
    share = [sum(r["value"] == "the same line" for r in sample_k(lines, 20, seed).collect()) for seed in range(40)]
    # 800 draws; the standard deviation of the share is below 0.018
    assert abs(sum(share) / 800 - 0.6) < 0.07
    assert min(share) < max(share)


def test_sample_counts(spark, workdir):
    lines = read_lines(spark, _files(workdir, {"rows.txt": ["a"] * 7}), position=True)
    assert sample_k(lines, 10).count() == 7 and sample_k(lines, 0).count() == 0 and sample_k(lines, 3).columns == lines.columns


@pytest.mark.parametrize("size", [5, 40, 1 << 20])
@pytest.mark.parametrize("position", [True, False])
def test_headers_go_by_place_and_blank_lines_stay(spark, workdir, split_at, size, position):
    files = {
        "a.txt": ["h", "x", "", "y", "h", "   ", '"q, \\ z'],
        "b.txt": ["a long header line " * 5, "", "", "1"],
        "c.txt": ["", "after a blank header"],
        "d.txt": ["only a header"],
        "0.txt": [],
    }
    path = _files(workdir, files)
    split_at(size)
    every = read_lines(spark, path, header="each", position=position).select("value").collect()
    assert sorted(r["value"] for r in every) == sorted(v for rows in files.values() for v in rows[1:])
    first = read_lines(spark, path, header="first", position=position).select("value").collect()
    assert sorted(r["value"] for r in first) == sorted(files["a.txt"][1:] + [v for n in ("b", "c", "d") for v in files[f"{n}.txt"]])


def test_unknown_header_mode_is_rejected(spark, workdir):
    with pytest.raises(ValueError):
        read_lines(spark, _files(workdir, {"a.txt": ["x"]}), header="none")


def test_positions_keep_the_columns_of_a_table(spark):
    rows = numbered_rows(spark.read.parquet(f"{SF}/region.parquet"))
    assert rows.columns[-2:] == ["file", "line_no"] and rows.where(F.col("line_no") == 0).count() == 1
