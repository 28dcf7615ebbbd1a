"""Aggregations.

All of them are algebraic Catalyst aggregates, so Spark plans them as a
partial ``HashAggregate`` in every map task, one exchange of one small buffer
per key and task, and a final ``HashAggregate`` (the map-side combine, A9).
A key holding a third of all rows therefore costs one buffer per task, not a
third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.functions.parse import parse_double_or_nan


def _cols(keys: str | Column | Sequence[str | Column]) -> list[Column]:
    if isinstance(keys, (str, Column)):
        keys = [keys]
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def grouped_mean(df: DataFrame, keys, value: str | Column, alias: str = "mean_value") -> DataFrame:
    """Exact grouped mean of a double (A1, A4 after a union).

    Catalyst's ``avg`` buffer is (sum, count); partial buffers merge exactly,
    so the result does not depend on how the input was split.
    """
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_cols(keys)).agg(F.avg(v.cast("double")).alias(alias))


def grouped_max(df: DataFrame, keys, value: str | Column, floor=None, alias: str = "max_value") -> DataFrame:
    """Grouped maximum; with ``floor`` the result never drops below it (A2: -9999)."""
    v = F.col(value) if isinstance(value, str) else value
    m = F.max(v)
    if floor is not None:
        m = F.greatest(m, F.lit(floor))
    return df.groupBy(*_cols(keys)).agg(m.alias(alias))


def grouped_max_floor_zero(df: DataFrame, keys, value: str | Column, alias: str = "max_value") -> DataFrame:
    """Grouped maximum of a double, floored at 0; NaN never wins (A3).

    Spark orders NaN above every number, so NaN is masked before ``max``; a
    group with only NaN (or only negatives) gives 0.
    """
    v = F.col(value) if isinstance(value, str) else value
    masked = F.when(~F.isnan(v), v)
    return df.groupBy(*_cols(keys)).agg(
        F.greatest(F.coalesce(F.max(masked), F.lit(0.0)), F.lit(0.0)).alias(alias)
    )


def global_stddev(df: DataFrame, value: str | Column, alias: str = "stddev") -> DataFrame:
    """Population standard deviation over all rows, one row.

    Empty input gives no row (not a NULL row).
    """
    v = F.col(value) if isinstance(value, str) else value
    return (
        df.agg(F.count(v).alias("_n"), F.stddev_pop(v.cast("double")).alias(alias))
        .where(F.col("_n") > 0)
        .select(alias)
    )


def profile_values(fields: Column | str, width: int, on_bad: str = "fail") -> list[Column]:
    """Per-column doubles of a ``width``-wide record for the profile.

    Unparsable text is NaN; a missing trailing field counts as 0; a record
    wider than ``width`` fails (``on_bad="fail"``) or is ignored by the caller's
    filter (``on_bad="drop"``).
    """
    arr = F.col(fields) if isinstance(fields, str) else fields
    out = []
    for i in range(width):
        x = F.when(F.size(arr) > i, parse_double_or_nan(F.get(arr, i))).otherwise(F.lit(0.0))
        if on_bad == "fail":
            x = F.when(F.size(arr) <= width, x).otherwise(
                F.raise_error(F.lit(f"record wider than {width} fields")).cast("double")
            )
        out.append(x)
    return out


#: Above this many columns a profile is taken in the long form.
WIDE_PROFILE = 64


def _long_profile(src: DataFrame, fields: str, width: int, wanted: Sequence[int], on_bad: str) -> DataFrame:
    """The profile of many columns: each record becomes (column, value) rows, whose moments
    (count, mean, squared deviations) are combined in the task and merged by column.

    The plan is the same for any width; a task holds one buffer for each column.
    """
    arr = F.col(fields)
    at = lambda i: F.when(F.size(arr) > i, parse_double_or_nan(F.get(arr, i))).otherwise(F.lit(0.0))
    pairs = F.transform(F.lit([int(i) for i in wanted]), lambda i: F.struct(i.alias("col_idx"), at(i).alias("x")))
    if on_bad == "fail":
        pairs = F.when(F.size(arr) <= width, pairs).otherwise(F.raise_error(F.lit(f"record wider than {width} fields")).cast("array<struct<col_idx:int,x:double>>"))
    return src.select(F.inline(pairs)).groupBy("col_idx").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))


def column_profile(
    df: DataFrame,
    fields: str = "fields",
    width: int | None = None,
    on_bad: str = "fail",
    columns: Sequence[int] | None = None,
) -> DataFrame:
    """Mean and population std dev of every column in one pass.

    Returns the long form ``DataFrame[col_idx INT, mean DOUBLE, std DOUBLE]``:
    one global aggregate with two buffers per column (partial aggregation in
    every task, one row per task through the exchange), then an unpivot of its
    single row. More than ``WIDE_PROFILE`` columns are profiled in the long form
    instead, whose plan does not grow with the width. ``width`` defaults to the first
    record's width (one row fetched). ``columns`` restricts the work to those column
    positions. Empty input gives no rows.
    """
    if width is None:
        first = df.select(F.size(fields).alias("w")).first()
        if first is None:
            return df.sparkSession.createDataFrame([], "col_idx INT, mean DOUBLE, std DOUBLE")
        width = int(first["w"])
    wanted = list(range(width)) if columns is None else [int(c) for c in columns]
    src = df
    if on_bad == "drop":
        src = src.where(F.size(fields) <= width)
    if len(wanted) > WIDE_PROFILE:
        return _long_profile(src, fields, width, wanted, on_bad)
    xs = profile_values(fields, width, on_bad)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i in wanted:
        x = xs[i] if i < width else F.lit(0.0)
        aggs.append(F.avg(x).alias(f"m{i}"))
        aggs.append(F.stddev_pop(x).alias(f"s{i}"))
    wide = src.agg(*aggs).where(F.col("_n") > 0)
    rows = F.array(
        *[F.struct(F.lit(i).alias("col_idx"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std")) for i in wanted]
    )
    return wide.select(F.inline(rows))
