"""Text sinks (K1-K6).

Results are written partitioned (one part file per task). Where one file is asked for,
the part files are joined on the file system; no task holds them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.files import merge_parts


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def key_value_lines(df: DataFrame, key: str | Column, value: str | Column, sep: str = "\t") -> DataFrame:
    """``key<TAB>value`` lines (K1)."""
    return df.select(F.concat_ws(sep, _text(key), _text(value)).alias("value"))


def single_column_lines(df: DataFrame, column: str | Column) -> DataFrame:
    """Value-only (or key-only) lines: the null side is simply absent (K2)."""
    return df.select(_text(column).alias("value"))


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists", merge: bool = False, order_by: str | None = None) -> None:
    """Write a one-column frame as text.

    ``mode="overwrite"`` replaces an existing output (K4); the default refuses
    to, like a single job does. ``order_by`` sorts the lines over all part files.
    ``merge=True`` leaves one file (K3): the parts are written as ever and then joined
    in their order (see ``statforge.files``), so the output may be of any size.
    """
    out = lines.orderBy(order_by) if order_by is not None else lines
    cols = [c for c in out.columns if c != order_by] if order_by else out.columns
    out.select(cols[0]).write.mode(mode).text(path)
    if merge:
        merge_parts(lines.sparkSession, path)


def _join_doubles(arr: Column, sep: str = "\t") -> Column:
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)


def moments_lines(moments: DataFrame, sep: str = "\t") -> DataFrame:
    """Two lines from the long moments frame: means, then std devs (K5).

    The moments frame has one row per profiled column (bounded by the record
    width). Place ``i`` of a line belongs to column ``i``; columns that were not
    profiled are NaN, so positions never shift.
    """
    listed = moments.agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", F.struct("mean", "std")))).alias("by_idx"), F.max("col_idx").alias("last")
    )
    nan = F.lit(float("nan"))

    def at(i: Column) -> Column:
        s = F.try_element_at(F.col("by_idx"), i.cast("int"))
        return F.struct(F.coalesce(s["mean"], nan).alias("mean"), F.coalesce(s["std"], nan).alias("std"))

    packed = listed.select(F.when(F.col("last").isNull(), F.array()).otherwise(F.transform(F.sequence(F.lit(0), F.col("last").cast("int")), at)).alias("m"))
    return packed.select(
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("line_no"), _join_doubles(F.transform("m", lambda s: s["mean"]), sep).alias("value")),
                F.struct(F.lit(1).alias("line_no"), _join_doubles(F.transform("m", lambda s: s["std"]), sep).alias("value")),
            )
        )
    )


def centroid_lines(centroids: DataFrame, sep: str = "\t") -> DataFrame:
    """One line per centroid, ``cluster`` order kept in ``line_no`` (K6)."""
    return centroids.select(F.col("cluster").alias("line_no"), _join_doubles(F.col("center"), sep).alias("value"))


def write_moments(moments: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_lines(moments_lines(moments), path, mode=mode, merge=True, order_by="line_no")


def write_centroids(centroids: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_lines(centroid_lines(centroids), path, mode=mode, merge=True, order_by="line_no")


def write_key_value(df: DataFrame, key, value, path: str, mode: str = "errorifexists") -> None:
    write_lines(key_value_lines(df, key, value), path, mode=mode)


__all__: Sequence[str] = [
    "centroid_lines",
    "key_value_lines",
    "moments_lines",
    "single_column_lines",
    "write_centroids",
    "write_key_value",
    "write_lines",
    "write_moments",
]
