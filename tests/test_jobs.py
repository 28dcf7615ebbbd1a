"""The summary jobs on hand-made records, including the edge rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statforge.plans import jobs
from tests.conftest import lines


def _row(n_fields, values: dict, sep=","):
    out = [""] * n_fields
    for i, v in values.items():
        out[i] = v
    return sep.join(out)


# ---------------------------------------------------------------- flag mean
def test_flag_group_mean_defaults(spark):
    recs = [
        _row(35, {3: "10", 29: "a", 30: "b", 31: "c", 32: "d", 34: "false"}),
        _row(35, {3: "20", 29: "a", 30: "b", 31: "c", 32: "d", 34: "FALSE"}),
        _row(35, {3: "99", 29: "a", 30: "b", 31: "c", 32: "d", 34: "true"}),
        # trailing empty fields: the last non-empty field is the flag
        _row(35, {3: "30", 29: "a", 30: "b", 31: "c", 32: "d", 33: "False"}) + ",,",
        _row(35, {3: "5", 29: "x", 30: "y", 31: "z", 32: "w", 34: "False"}),
    ]
    got = {r["group_key"]: r["mean_value"] for r in jobs.flag_group_mean(lines(spark, recs)).collect()}
    assert got == {"a, b, c, d": 20.0, "x, y, z, w": 5.0}


def test_flag_group_mean_bad_number_fails(spark):
    recs = [_row(35, {3: "oops", 29: "a", 30: "b", 31: "c", 32: "d", 34: "false"})]
    with pytest.raises(Exception, match="not a number"):
        jobs.flag_group_mean(lines(spark, recs)).collect()
    assert jobs.flag_group_mean(lines(spark, recs), on_bad="drop").count() == 0


# ---------------------------------------------------------------- fixed width
def _station(year, sign, reading, quality):
    return "0" * 15 + year + " " * 68 + sign + reading + quality + "extra"


def test_station_year_max(spark):
    recs = [
        _station("1901", "+", "0317", "1"),
        _station("1901", "+", "9999", "1"),  # missing
        _station("1901", "+", "0400", "2"),  # bad quality
        _station("1902", "-", "0011", "0"),
        _station("1902", "-", "9999", "4"),  # -9999 is a value
        _station("1903", "-", "0050", "9"),
    ]
    got = {r["year"]: r["max_value"] for r in jobs.station_year_max(lines(spark, recs)).collect()}
    assert got == {"1901": 317, "1902": -11, "1903": -50}


def test_station_short_record(spark):
    with pytest.raises(Exception, match="shorter than 93"):
        jobs.station_year_max(lines(spark, ["too short"])).collect()
    assert jobs.station_year_max(lines(spark, ["too short"]), on_bad="drop").count() == 0


# ---------------------------------------------------------------- projection
def test_year_range_projection(spark):
    def song(year, title="t", artist="a", dur="1.5"):
        return _row(166, {1: title, 2: artist, 3: dur, 165: year})

    recs = [song("2000"), song("2010", title="u"), song("1999"), song("2011"), song("2005.0"), song(" 2005 "), song("+2005", title="p")]
    got = sorted(tuple(r) for r in jobs.year_range_projection(lines(spark, recs)).collect())
    assert got == [("a", "1.5", "p", "+2005"), ("a", "1.5", "t", "2000"), ("a", "1.5", "u", "2010")]
    out = jobs.projection_lines(jobs.year_range_projection(lines(spark, [song("2001")]))).first()[0]
    assert out == "a\t1.5\tt\t2001"


# ---------------------------------------------------------------- max floored at 0
def test_group_max_floor_zero(spark):
    recs = ["0,t,neg,-5", "0,t,neg,-1", "0,t,mix,NaN", "0,t,mix,3.5", "0,t,nan,NaN", "0,t,bad,xyz", "0,t,pos,7"]
    got = {r["key"]: r["max_value"] for r in jobs.group_max_floor(lines(spark, recs)).collect()}
    assert got == {"neg": 0.0, "mix": 3.5, "nan": 0.0, "pos": 7.0}


@pytest.mark.parametrize(
    "key,bucket",
    [("Abba", 0), ("F", 1), ("Eagles", 0), ("Kiss", 2), ("Pink", 3), ("U2", 4), ("Zz", 4), ("abba", 4), ("3 Doors", 0), ("Élan", 4), ("", 0)],
)
def test_first_char_bucket(spark, key, bucket):
    from statforge.operators.order import first_char_bucket

    df = spark.createDataFrame([(key,)], "k STRING")
    assert df.select(first_char_bucket("k")).first()[0] == bucket


def test_range_partitioned_max_places_buckets(spark):
    keys = ["Abba", "Blur", "Fugees", "Kiss", "Muse", "Pink", "Queen", "U2", "Zappa", "Heart"]
    recs = [f"0,t,{k},{i + 1}.0" for i, k in enumerate(keys)]
    out = jobs.range_partitioned_max(lines(spark, recs), parts_per_bucket=1)
    assert out.rdd.getNumPartitions() == 5
    rows = out.select("key", "bucket", F.spark_partition_id().alias("pid")).collect()
    assert all(r["bucket"] == r["pid"] for r in rows)
    per_part = out.rdd.glom().map(lambda rs: [r["key"] for r in rs]).collect()
    assert all(p == sorted(p) for p in per_part)
    assert per_part[0] == ["Abba", "Blur"]


# ---------------------------------------------------------------- n-grams
def test_ngram_substring_mean(spark):
    uni = [
        "nuklaus 1999 1 10",  # holds "nu" and "kla": counts in both
        "Nudie 1999 1 20",  # "nu" and "die"
        "other 1999 1 99",
        "nub 01999 1 30",  # same year written differently: its own key
        "nut 2000 1 x",  # volumes not an integer: dropped
    ]
    bi = [
        "nut nuance  1999 1 40",  # "nu" in both words: counts once
        "the diet 1999 1 50",
        "klang x 1999.5 1 60",  # year not an integer: dropped
    ]
    got = {r["tag_key"]: r["mean_volumes"] for r in jobs.ngram_substring_mean(lines(spark, uni), lines(spark, bi)).collect()}
    assert got == {
        "1999 | nu": (10 + 20 + 40) / 3,
        "1999 | kla": 10.0,
        "1999 | die": (20 + 50) / 2,
        "01999 | nu": 30.0,
    }


def test_ngram_volume_stddev(spark):
    uni = ["a 1999 1 10", "b 1999 1 20", "c 1999 1 x"]
    bi = ["a b 1999 1 40", "c d 1999 1 70"]
    got = jobs.ngram_volume_stddev(lines(spark, uni), lines(spark, bi)).collect()
    assert len(got) == 1
    assert got[0]["stddev"] == pytest.approx(np.std([10, 20, 40, 70]))
    empty = jobs.ngram_volume_stddev(lines(spark, []), lines(spark, []))
    assert empty.count() == 0


# ---------------------------------------------------------------- profile and subset
def test_column_moments(spark):
    recs = ["1\tA\t5\t2", "3\tB\t5\t4", "5\tC\t5"]  # last row misses a trailing field: it counts 0
    got = {r["col_idx"]: (r["mean"], r["std"]) for r in jobs.column_moments(lines(spark, recs)).collect()}
    assert got[0] == pytest.approx((3.0, np.std([1, 3, 5])))
    assert math.isnan(got[1][0]) and math.isnan(got[1][1])
    assert got[2] == (5.0, 0.0)
    assert got[3] == pytest.approx((2.0, np.std([2, 4, 0])))


def test_column_moments_header_poisons_and_empty(spark):
    got = jobs.column_moments(lines(spark, ["x\ty", "1\t2"])).collect()
    assert all(math.isnan(r["mean"]) for r in got)
    assert jobs.column_moments(lines(spark, []), width=2).count() == 0


def test_column_moments_wider_row(spark):
    with pytest.raises(Exception, match="wider than 2"):
        jobs.column_moments(lines(spark, ["1\t2", "1\t2\t3"])).collect()


def test_subset_rows(spark):
    def rec(f18, f23, f6="I", f13="Internal Medicine"):
        return _row(27, {6: f6, 13: f13, 18: f18, 23: f23}, sep="\t")

    keep = [rec("500", "1000"), rec("NaN", "10"), rec("1", "1", f13="Family Practice")]
    drop = [rec("500.01", "1"), rec("1", "1000.5"), rec("1", "1", f6="O"), rec("1", "1", f13="Surgery")]
    got = [r["value"] for r in jobs.subset_rows(lines(spark, keep + drop)).collect()]
    assert sorted(got) == sorted(keep)


def test_range_partitioned_split_hot_bucket(spark):
    # most keys start with "B": with parts_per_bucket the hot bucket spans
    # several partitions, and partitions in order still read sorted by (bucket, key)
    keys = [f"B{i:03d}" for i in range(60)] + ["Abba", "Kiss", "Zappa", "Pink"]
    recs = [f"0,t,{k},{i}.0" for i, k in enumerate(keys)]
    out = jobs.range_partitioned_max(lines(spark, recs).repartition(4), parts_per_bucket=4)
    parts = out.rdd.glom().map(lambda rs: [(r["bucket"], r["key"]) for r in rs]).collect()
    flat = [x for p in parts for x in p]
    assert flat == sorted(flat) and len(flat) == len(keys)
    assert sum(1 for p in parts if p and all(b == 0 for b, _ in p)) >= 2


def test_large_volumes_do_not_wrap(spark):
    # the per-key sum exceeds 32 and the square sum 64 bits: means and std dev stay exact
    uni = ["nu 1999 1 2000000000", "nu 1999 1 2000000000", "nu 1999 1 2147483647"]
    bi = ["nu x 1999 1 4000000000"]  # beyond int: not a valid int volume, dropped from the mean
    got = {r["tag_key"]: r["mean_volumes"] for r in jobs.ngram_substring_mean(lines(spark, uni), lines(spark, bi)).collect()}
    assert got == {"1999 | nu": (2000000000 * 2 + 2147483647) / 3}
    sd = jobs.ngram_volume_stddev(lines(spark, uni), lines(spark, bi)).first()["stddev"]
    assert sd == pytest.approx(np.std([2000000000, 2000000000, 2147483647, 4000000000]), rel=1e-12)


def test_short_records_that_match_nothing_are_not_read(spark):
    uni, bi = lines(spark, ["foo", "nub 1999 1 10"]), lines(spark, ["the nut 1999 1 20"])
    got = {r["tag_key"]: r["mean_volumes"] for r in jobs.ngram_substring_mean(uni, bi, ["nu"]).collect()}
    assert got == {"1999 | nu": 15.0}
    with pytest.raises(Exception, match="record has no field 1"):
        jobs.ngram_substring_mean(lines(spark, ["nub"]), bi, ["nu"]).collect()


def test_dropped_records_leave_no_shortened_keys(spark):
    recs = ["k1,k2,1.0,false", "k1,2.0,false", "k1,k2,3.0,false"]
    out = jobs.flag_group_mean(lines(spark, recs), value_index=2, key_indices=(0, 1, 3), on_bad="drop").collect()
    assert [(r["group_key"], r["mean_value"]) for r in out] == [("k1, k2, false", 2.0)]
    # a record too short for its key fails even if its flag would have dropped it
    with pytest.raises(Exception, match="record has no field"):
        jobs.flag_group_mean(lines(spark, ["k1,true"]), value_index=1, key_indices=(0, 5)).collect()
