"""Sources and sinks on real files: plain and gzip text, parameter files."""

from __future__ import annotations

import gzip
import math
import os

import pytest
from pyspark.sql import functions as F

from statforge import sinks
from statforge.plans import jobs
from statforge.sources import (
    centroids_frame,
    centroids_to_list,
    moments_to_lists,
    read_centroids,
    read_lines,
    read_moments,
    read_variables,
    redelimit,
)
from statforge.sources.text import cut_fields
from statforge.functions.parse import split_fields
from tests.conftest import lines


def _write(path, text, gz=False):
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)
    return path


def test_read_plain_and_gzip(spark, workdir):
    _write(os.path.join(workdir, "a.txt"), "a 1999 1 10\nb 1999 1 20\n")
    _write(os.path.join(workdir, "b.txt.gz"), "c 1999 1 30\n", gz=True)
    df = read_lines(spark, workdir)
    assert sorted(r["value"] for r in df.collect()) == ["a 1999 1 10", "b 1999 1 20", "c 1999 1 30"]


def test_parameter_files(spark, workdir):
    cpath = _write(os.path.join(workdir, "centroids"), "1.25 -7.5 \n0.75  12.125\t\n")
    assert centroids_to_list(read_centroids(spark, cpath)) == [[1.25, -7.5], [0.75, 12.125]]
    vpath = _write(os.path.join(workdir, "vars"), "3 8 11 \n")
    assert read_variables(spark, vpath) == [3, 8, 11]
    mpath = _write(os.path.join(workdir, "moments"), "1.5\tNaN\t2.0\n0.5\tNaN\t1.0\n")
    means, stds = moments_to_lists(read_moments(spark, mpath))
    assert means[0] == 1.5 and math.isnan(means[1]) and stds[2] == 1.0


def test_nan_centroid_rejected(spark, workdir):
    cpath = _write(os.path.join(workdir, "c"), "1.0 NaN\n")
    with pytest.raises(Exception, match="NaN in a centroid"):
        read_centroids(spark, cpath).collect()


def test_moments_and_centroid_files_round_trip(spark, workdir):
    mom = jobs.column_moments(lines(spark, ["1\tx\t3", "3\ty\t5"]))
    mpath = os.path.join(workdir, "mom")
    sinks.write_moments(mom, mpath)
    text = sorted(open(os.path.join(mpath, f)).read() for f in os.listdir(mpath) if f.startswith("part-"))
    assert text == ["2.0\tNaN\t4.0\n1.0\tNaN\t1.0\n"]
    back = {r["col_idx"]: r["mean"] for r in read_moments(spark, mpath).collect()}
    assert back[0] == 2.0 and math.isnan(back[1])
    cpath = os.path.join(workdir, "cent")
    sinks.write_centroids(centroids_frame(spark, [[2.0000000000000004e9, 7.000000000000001e-05], [1.0, -2.5]]), cpath)
    assert centroids_to_list(read_centroids(spark, cpath)) == [[2.0000000000000004e9, 7.000000000000001e-05], [1.0, -2.5]]
    part = [f for f in os.listdir(cpath) if f.startswith("part-")]
    assert open(os.path.join(cpath, part[0])).read() == "2.0000000000000005E9\t7.000000000000001E-5\n1.0\t-2.5\n"


def test_key_value_sink_and_modes(spark, workdir):
    df = spark.createDataFrame([("a", 1.5), ("b", 2.0)], "k STRING, v DOUBLE")
    path = os.path.join(workdir, "kv")
    sinks.write_key_value(df, "k", "v", path)
    assert sorted(r["value"] for r in read_lines(spark, path).collect()) == ["a\t1.5", "b\t2.0"]
    with pytest.raises(Exception):
        sinks.write_key_value(df, "k", "v", path)  # existing output is not replaced by default
    sinks.write_lines(sinks.key_value_lines(df, "k", "v"), path, mode="overwrite")


def test_redelimit_cut(spark):
    red = redelimit(lines(spark, ["  0  1   2 ", "", "   ", "a\tb"]))
    assert [r["value"] for r in red.collect()] == ["0\t1\t2", "a\tb"]
    cut = lines(spark, ["a\tb\tc\td"]).select(cut_fields(split_fields(F.col("value"), "\t"), [1, 3, 9]).alias("c"))
    assert cut.first()["c"] == "a\tc"


def test_header_is_left_out_by_position(spark, workdir):
    # the larger file is scanned first and has no header of its own name
    d = os.path.join(workdir, "headed")
    os.makedirs(d)
    _write(os.path.join(d, "a.txt"), "name\tv\nx\t1\nname\tv\n")
    _write(os.path.join(d, "b.txt"), "y\t2\n" * 2 + "".join(f"z{i}\t{i}\n" for i in range(50)))
    every = sorted(r["value"] for r in read_lines(spark, d, header="each").collect())
    assert every == sorted(["x\t1", "name\tv", "y\t2", *[f"z{i}\t{i}" for i in range(50)]])
    first = sorted(r["value"] for r in read_lines(spark, d, header="first").collect())
    assert first == sorted(["x\t1", "name\tv", "y\t2", "y\t2", *[f"z{i}\t{i}" for i in range(50)]])
    odd = _write(os.path.join(workdir, "odd.txt"), 'h"ead,x\n"quoted, \\ line\n  padded  \n#no comment\n')
    assert [r["value"] for r in read_lines(spark, odd, header="each").collect()] == ['"quoted, \\ line', "  padded  ", "#no comment"]


def test_moments_keep_their_columns(spark, workdir):
    mom = jobs.column_moments(lines(spark, ["9\t1\t9\t3", "9\t3\t9\t5"]), columns=[1, 3])
    path = os.path.join(workdir, "some")
    sinks.write_moments(mom, path)
    means, stds = moments_to_lists(read_moments(spark, path))
    assert math.isnan(means[0]) and means[1] == 2.0 and math.isnan(means[2]) and means[3] == 4.0 and stds[3] == 1.0


def test_parameter_directory_of_part_files(spark, workdir):
    d = os.path.join(workdir, "cdir")
    os.makedirs(d)
    _write(os.path.join(d, "part-00001"), "5 6\n\n7 8\n")
    _write(os.path.join(d, "part-00000"), "1 2\n3 4\n")
    assert centroids_to_list(read_centroids(spark, d)) == [[1.0, 2.0], [3.0, 4.0], [5.0, 6.0], [7.0, 8.0]]


def test_text_files_at_table_scale(spark, workdir):
    """Profile and pipeline over text files equal the same over the rendered table."""
    from statforge.plans import tables
    from statforge.plans.clustering import run_clustering

    sf = "/root/testdata/sf0.001"
    rendered = tables.lineitem_tab_lines(spark, sf)
    path = os.path.join(workdir, "lineitem_txt")
    sinks.write_lines(rendered.repartition(3), path)
    text = read_lines(spark, path)
    assert text.count() == 6000

    a = {r["col_idx"]: r for r in jobs.column_moments(rendered, width=11).collect()}
    b = {r["col_idx"]: r for r in jobs.column_moments(text).collect()}
    for i in range(8):
        assert a[i]["mean"] == pytest.approx(b[i]["mean"], rel=1e-12)
        assert a[i]["std"] == pytest.approx(b[i]["std"], rel=1e-9)
    pa = run_clustering(rendered, k=3, max_iter=20, variables=[4, 5, 6])
    pb = run_clustering(text, k=3, max_iter=20, variables=[4, 5, 6], init_centers_raw=pa.init_centers_raw)
    assert pa.fit.iterations == pb.fit.iterations
    sa = sorted(tuple(r) for r in pa.cluster_sizes().collect())
    sb = sorted(tuple(r) for r in pb.cluster_sizes().collect())
    assert sa == sb and sum(n for _, n in sa) == 6000


def test_scratch_paths_live_under_the_session_checkpoint_dir(spark):
    from statforge.session import checkpoint_dir, scratch_path

    base = spark.sparkContext.getCheckpointDir()
    assert base and checkpoint_dir(spark) == base
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base.rstrip("/") + "/") and a != b
