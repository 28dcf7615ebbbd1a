"""Field splitting and strict number parsing (Java semantics)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from statforge.functions.parse import (
    COMMA,
    TAB,
    WHITESPACE,
    field,
    last_field,
    parse_double,
    parse_double_or_nan,
    parse_int,
    parse_long,
    split_fields,
)


def _eval(spark, values, expr_fn, dtype="STRING"):
    df = spark.createDataFrame([(v,) for v in values], f"s {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("s"))).collect()]


@pytest.mark.parametrize(
    "line,delim,expected",
    [
        ("a,b,,", COMMA, ["a", "b"]),
        ("a,,b", COMMA, ["a", "", "b"]),
        (",a", COMMA, ["", "a"]),
        (",,,", COMMA, []),
        ("", COMMA, [""]),
        ("a\tb\t\t", TAB, ["a", "b"]),
        (" a  b  ", WHITESPACE, ["", "a", "b"]),
        ("a \t b", WHITESPACE, ["a", "b"]),
        ("   ", WHITESPACE, []),
    ],
)
def test_split_like_java(spark, line, delim, expected):
    assert _eval(spark, [line], lambda c: split_fields(c, delim)) == [expected]


def test_last_field_is_last_non_empty(spark):
    got = _eval(spark, ["x,y,false,,", "x", ",,"], lambda c: last_field(split_fields(c, COMMA)))
    assert got == ["false", "x", None]


def test_field_out_of_range(spark):
    df = spark.createDataFrame([("a,b",)], "s STRING").select(split_fields("s", COMMA).alias("f"))
    assert df.select(field("f", 5, "null")).first()[0] is None
    assert df.select(field("f", 1, "fail")).first()[0] == "b"
    with pytest.raises(Exception, match="no field 5"):
        df.select(field("f", 5, "fail")).collect()


def test_parse_int_strict(spark):
    vals = [" 2005 ", "2005.0", "+5", "-7", "", "99999999999", "2005", "01999", "1e3"]
    assert _eval(spark, vals, parse_int) == [None, None, 5, -7, None, None, 2005, 1999, None]


def test_parse_long_range(spark):
    assert _eval(spark, ["99999999999", "9223372036854775808"], parse_long) == [99999999999, None]


def test_parse_double_java_grammar(spark):
    vals = ["1.5", " 2.5 ", "1d", "2.5f", "0x1p3", ".5", "5.", "1e5", "NaN", "-Infinity", "+Infinity"]
    got = _eval(spark, vals, parse_double)
    assert got[:8] == [1.5, 2.5, 1.0, 2.5, 8.0, 0.5, 5.0, 100000.0]
    assert math.isnan(got[8]) and got[9] == -math.inf and got[10] == math.inf


def test_parse_double_rejects_non_java_spellings(spark):
    vals = ["nan", "inf", "+inf", "INFINITY", "", "abc", "1,5", "1_000"]
    assert _eval(spark, vals, parse_double) == [None] * len(vals)


def test_parse_double_overflow_is_infinity(spark):
    assert _eval(spark, ["1e999", "-1e999"], parse_double) == [math.inf, -math.inf]


def test_parse_or_nan(spark):
    got = _eval(spark, ["3.25", "A", "1995-01-02 00:00:00"], parse_double_or_nan)
    assert got[0] == 3.25 and math.isnan(got[1]) and math.isnan(got[2])


def test_only_lines_that_end_with_a_delimiter_are_trimmed(spark):
    texts = ["a\tb", "a\tb\t\t", "\t\t", "", "\ta", "a\t ", None, " ", "é\t"]
    df = spark.createDataFrame([(t,) for t in texts], "value STRING").coalesce(1)
    tabs = [r["f"] for r in df.select(split_fields("value", "\t").alias("f")).collect()]
    assert tabs == [["a", "b"], ["a", "b"], [], [""], ["", "a"], ["a", " "], None, [" "], ["é"]]
    blanks = [r["f"] for r in df.select(split_fields("value", r"\s+").alias("f")).collect()]
    assert blanks == [["a", "b"], ["a", "b"], [], [""], ["", "a"], ["a"], None, [], ["é"]]
    plan = df.select(split_fields("value", "\t").alias("f"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("EndsWith" if "EndsWith" in plan else "endswith") < plan.index("rtrim" if "rtrim" in plan else "trim")
