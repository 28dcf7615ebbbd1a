"""Text-line sources: one record per line, fields by position.

All scans return ordinary DataFrames; Spark splits the files into tasks
(``spark.sql.files.maxPartitionBytes``), and gzip inputs are read per file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.functions.parse import LAYOUTS, split_fields
from statforge.sources.position import carried, numbered_lines, without_headers

# awk's default field separator: runs of blanks, tabs and newlines.
_AWK_BLANKS = "[ \t\n]+"


def read_lines(
    spark: SparkSession, path: str | Sequence[str], line_sep: str | None = None, header: str | None = None, position: bool = False
) -> DataFrame:
    """Scan text files (a file, a directory or a glob) as ``DataFrame[value]``.

    ``header="each"`` leaves out the first line of every file, ``"first"`` the
    first line of the first file by path that has any. Lines are left out by their
    position, never by their content, however the files are split. ``position``
    adds ``file`` and ``line_no``. Either takes a pass that counts lines
    (see ``statforge.sources.position``).
    """
    paths = [path] if isinstance(path, str) else list(path)
    if header not in (None, "each", "first"):
        raise ValueError(f"header must be None, 'each' or 'first', not {header!r}")
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    lines = reader.text(paths)
    if position:
        rows = numbered_lines(lines)
        if header is None:
            return rows
        is_head = F.col("line_no") == 0
        if header == "first":
            first = rows.where(is_head).agg(F.min("file").alias("file")).first()["file"]
            is_head = is_head & (F.col("file") == F.lit(first))
        return rows.where(~F.coalesce(is_head, F.lit(False)))
    return lines if header is None else without_headers(lines, header)


def lines_from_columns(df: DataFrame, columns: Sequence[str | Column], sep: str, name: str = "value") -> DataFrame:
    """Render typed columns as delimited text lines (the ``read.text`` shape).

    NULLs become empty fields, so field positions never shift. The rows' positions
    (``file``, ``line_no``) go along if the frame has them.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws(sep, *parts).alias(name), *carried(df))


def parse_delimited(
    lines: DataFrame,
    layout: str = "comma",
    column: str = "value",
    out: str = "fields",
    keep_trailing_empty: bool = False,
) -> DataFrame:
    """Comma / tab / whitespace-run split of each line into ``out: array<string>``.

    The split is the naive one (no quoting), as the original jobs use; a
    quote-aware CSV reader would produce different fields.

    The split runs inside a one-row generator (``inline``). Catalyst pushes a
    filter through a projection by substituting the projected expression into
    every reference, which would split each line once per referenced field;
    a filter on generator output stays above it, so every line is split once.
    A frame that already has ``out`` is returned as it is.
    """
    if out in lines.columns:  # split by an earlier step of the same job
        return lines
    delimiter = LAYOUTS.get(layout, layout)
    return with_columns_once(lines, {out: split_fields(F.col(column), delimiter, keep_trailing_empty)})


def with_columns_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``withColumns``, evaluated once per row even when later filters refer to
    the new columns many times (see ``parse_delimited``)."""
    kept = [F.col(c) for c in df.columns if c not in columns]
    row = F.struct(*kept, *[expr.alias(name) for name, expr in columns.items()])
    return df.select(F.inline(F.array(row)))


def fixed_width(
    lines: DataFrame,
    spec: Mapping[str, tuple[int, int]],
    column: str = "value",
    on_bad: str = "fail",
) -> DataFrame:
    """Cut fixed-width fields; ``spec`` maps a name to a 0-based ``[start, end)``.

    A line shorter than the last field end fails the job (``on_bad="fail"``) or
    is dropped (``on_bad="drop"``).
    """
    need = max(end for _, end in spec.values())
    line = F.col(column)
    df = lines
    if on_bad == "drop":
        df = df.where(F.length(line) >= need)
    elif on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'drop', not {on_bad!r}")
    checked = line
    if on_bad == "fail":
        checked = F.when(F.length(line) >= need, line).otherwise(
            F.raise_error(F.concat(F.lit(f"fixed-width record shorter than {need}: "), line))
        )
    df = with_columns_once(df, {"_record": checked})
    cut = {name: F.substring(F.col("_record"), start + 1, end - start) for name, (start, end) in spec.items()}
    return with_columns_once(df, cut).drop("_record")


def redelimit(lines: DataFrame, out_sep: str = "\t", column: str = "value") -> DataFrame:
    """Rebuild each line with ``out_sep`` between its blank-separated fields.

    Leading and trailing blanks go away, runs of blanks become one separator.
    Empty (all-blank) lines are dropped; lines whose first field is zero are
    kept.
    """
    stripped = F.regexp_replace(F.col(column), "^[ \t\n]+|[ \t\n]+$", "")
    rebuilt = F.array_join(F.split(stripped, _AWK_BLANKS), out_sep)
    # built once per line even though the filter below refers to it
    return with_columns_once(lines.select(column), {column: rebuilt}).where(F.col(column) != "")


def cut_fields(fields: Column | str, positions_1based: Sequence[int], sep: str = "\t") -> Column:
    """``cut -f LIST``: the listed 1-based fields joined by ``sep``.

    Fields past the end of a record are left out, as cut does.
    """
    arr = F.col(fields) if isinstance(fields, str) else fields
    picked = F.array(*[F.get(arr, p - 1) for p in positions_1based])
    return F.array_join(picked, sep)
