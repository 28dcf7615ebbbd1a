"""Wide profiles and vectors, counts of dropped records, and outputs joined from part files."""

from __future__ import annotations

import math
import os
import statistics

import pytest
from pyspark.sql import functions as F

from statforge import sinks
from statforge.files import part_files
from statforge.operators import aggregate as agg
from statforge.operators.counted import DropCounts
from statforge.plans import jobs
from statforge.sources import read_lines
from tests.conftest import lines


# --------------------------------------------------------------------------- wide records
def _moments(frame):
    return {r["col_idx"]: (r["mean"], r["std"]) for r in frame.collect()}


def _same(a, b):
    return all((math.isnan(x) and math.isnan(y)) or x == pytest.approx(y, rel=1e-9, abs=1e-12) for x, y in zip(a, b))


def test_profile_of_five_thousand_columns(spark):
    rows = [[(i * 7 + j * 3) % 11 + j / 10 for j in range(5000)] for i in range(6)]
    texts = ["\t".join(map(str, r)) for r in rows]
    texts[2] = "\t".join(["text", *map(str, rows[2][1:4998])])  # one unparsable field, two missing ones
    got = _moments(jobs.column_moments(lines(spark, texts).repartition(3)))
    assert sorted(got) == list(range(5000))
    for j in (1, 2, 77, 4997):
        column = [r[j] for r in rows]
        assert _same(got[j], (statistics.fmean(column), statistics.pstdev(column)))
    assert math.isnan(got[0][0]) and math.isnan(got[0][1])
    last = [r[4999] if i != 2 else 0.0 for i, r in enumerate(rows)]
    assert _same(got[4999], (statistics.fmean(last), statistics.pstdev(last)))


def test_long_and_narrow_profiles_agree(spark, monkeypatch):
    texts = ["1\tx\t3.5", "2\t5", "4\t6\tNaN\t9", "", "7\t8\t1e3\t"]
    frame = lines(spark, texts)
    narrow = _moments(jobs.column_moments(frame, width=4))
    monkeypatch.setattr(agg, "WIDE_PROFILE", 1)
    assert {k: _same(v, narrow[k]) for k, v in _moments(jobs.column_moments(frame, width=4)).items()} == dict.fromkeys(range(4), True)
    some = _moments(jobs.column_moments(frame, width=4, columns=[3, 0]))
    assert sorted(some) == [0, 3] and _same(some[3], narrow[3])
    assert jobs.column_moments(lines(spark, []), width=4).collect() == []
    with pytest.raises(Exception, match="wider than 2 fields"):
        jobs.column_moments(frame, width=2).collect()
    dropped = _moments(jobs.column_moments(frame, width=2, on_bad="drop"))
    # "2\t5" and the empty record are left; the latter has one field, which is not a number
    assert math.isnan(dropped[0][0]) and dropped[1][0] == pytest.approx(2.5)


def test_long_profile_is_combined_in_the_tasks(spark):
    texts = lines(spark, ["\t".join(map(str, range(100)))] * 3)
    plan = jobs.column_moments(texts, width=100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "partial_avg" in plan and plan.count("Exchange") <= 2


def test_wide_features_equal_narrow_ones(spark, monkeypatch):
    frame = lines(spark, ["1\t2\t3", "4\tx\t6", "7\t8"])
    moments = ([1.0, 2.0, 3.0], [2.0, 4.0, 8.0])
    good = frame.where("value NOT LIKE '%x%'")
    get = lambda f, **kw: [r["x"] for r in jobs.feature_frame(f, [2, 0], "tab", **kw)[0].collect()]
    raw, scaled, null = get(good), get(good, moments=moments), get(frame, on_bad="null")
    monkeypatch.setattr(jobs, "WIDE_FEATURES", 1)
    assert get(good) == raw == [[3.0, 1.0], [None, 7.0]]
    assert get(good, moments=moments) == scaled and get(frame, on_bad="null") == null
    with pytest.raises(Exception, match="field 1 is not a number: x"):
        jobs.feature_frame(frame, [1, 0], "tab")[0].collect()


# --------------------------------------------------------------------------- counts of what is dropped
def test_dropped_and_kept_make_what_was_read(spark):
    counts = DropCounts()
    texts = ["0,a,1,1.5", "1,b,2,x", "2,a,3,-4", "3,c", "4,c,4,NaN", "5"]
    jobs.group_max_floor(lines(spark, texts).repartition(3), key=1, value=3, on_bad="null", counts=counts).collect()
    got = counts.get()["records"]
    assert got == {"read": 6, "kept": 3, "value is not a number": 3, "no key": 0}


def test_reasons_count_once_in_their_order(spark):
    counts = DropCounts()
    texts = ["t,a,1,1999", "t,a,1,1998.0", "t,a,1,x", "t,a,1,1890"]
    kept = jobs.year_range_projection(lines(spark, texts), title=0, artist=1, duration=2, year=3, years=(1990, 2000), counts=counts)
    assert kept.count() == 1
    assert counts.get() == {"records": {"read": 4, "kept": 1, "year is not an integer": 2, "year out of range": 1}}


def test_each_source_has_its_counts(spark):
    counts = DropCounts()
    uni, bi = lines(spark, ["nu 2000 1 5", "nu 2000 1 y", "zz 2000 1 5"]), lines(spark, ["nu kla 20x0 1 5", "a b 2000 1 5"])
    out = jobs.ngram_substring_mean(uni, bi, counts=counts).collect()
    assert [tuple(r) for r in out] == [("2000 | nu", 5.0)]
    got = counts.get()
    assert got["unigrams"] == {"read": 2, "kept": 1, "year is not an integer": 0, "volumes are not an integer": 1}
    assert got["bigrams"] == {"read": 2, "kept": 0, "year is not an integer": 2, "volumes are not an integer": 0}
    for by in got.values():
        assert by["read"] == by["kept"] + sum(n for k, n in by.items() if k not in ("read", "kept"))


def test_fields_read_as_nan_are_counted(spark):
    counts = DropCounts()
    jobs.column_moments(lines(spark, ["1\tx\tNaN", "y\tz\t3", "4"]), width=3, counts=counts).collect()
    assert counts.get() == {"records": {"read": 3, "fields that are not numbers": 3}}
    some = DropCounts()
    jobs.column_moments(lines(spark, ["1\tx\tNaN", "y\tz\t3", "4"]), width=3, columns=[0, 2], counts=some).collect()
    assert some.get()["records"]["fields that are not numbers"] == 1


def test_counts_do_not_change_a_result(spark):
    frame = lines(spark, ["0,a,1,1.5", "1,b,2,x", "2,a,3,-4"])
    plain = sorted(tuple(r) for r in jobs.range_partitioned_max(frame, key=1, value=3).collect())
    assert plain == sorted(tuple(r) for r in jobs.range_partitioned_max(frame, key=1, value=3, counts=DropCounts()).collect())


# --------------------------------------------------------------------------- one file from many parts
def test_parts_are_joined_in_order(spark, workdir):
    path = os.path.join(workdir, "out")
    rows = spark.range(5000).repartition(7).select("id", F.concat(F.lit("line "), F.col("id")).alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_lines(rows, path, merge=True, order_by="id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [f for f in sorted(os.listdir(path)) if f.startswith("part-")] == ["part-00000.txt"]
    with open(os.path.join(path, "part-00000.txt"), encoding="utf-8") as f:
        assert f.read() == "".join(f"line {i}\n" for i in range(5000))
    assert len(part_files(spark, path)) == 1
    assert read_lines(spark, path).count() == 5000


def test_joining_writes_with_as_many_tasks_as_there_are(spark):
    rows = spark.range(100).repartition(5).select("id", F.col("id").cast("string").alias("value"))
    assert "SinglePartition" not in rows.orderBy("id")._jdf.queryExecution().executedPlan().toString()


def test_joined_output_of_nothing_and_modes(spark, workdir):
    path = os.path.join(workdir, "none")
    none = spark.createDataFrame([], "value STRING")
    sinks.write_lines(none, path, merge=True)
    assert read_lines(spark, path).count() == 0 and os.path.exists(os.path.join(path, "part-00000.txt"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_lines(none, path, merge=True)
    sinks.write_lines(lines(spark, ["a", "b"]), path, mode="overwrite", merge=True)
    sinks.write_lines(lines(spark, ["c"]), path, mode="overwrite", merge=True)
    assert [r["value"] for r in read_lines(spark, path).collect()] == ["c"]
