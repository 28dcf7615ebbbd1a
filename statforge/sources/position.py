"""Where a row stands in its input: its file and its number in that file.

A row's position does not depend on how the files are split into tasks, and two rows
never share one, whatever they hold. Header lines are left out by it, and samples are
ranked by it.

* A parquet row's number is in the scan's metadata (``_metadata.row_index``).
* A text line's number follows from the start of its block (the split of the file that
  a task reads, ``_metadata.file_block_start``) and its place in the block: one pass
  that reads no values counts the lines of every block; a line's number is then the lines
  of the blocks before it in its file and its place. That table has one row for
  each split of the input and is written before it is used, so that the planner knows its
  size: a small one is broadcast, a larger one is joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statforge.session import scratch_path

#: Columns that name a row's position.
FILE, ROW = "file", "line_no"
POSITION = (FILE, ROW)


def has_position(df: DataFrame) -> bool:
    return set(POSITION) <= set(df.columns)


def carried(df: DataFrame) -> list[str]:
    """The position columns, if the frame has them (for steps that hand rows on)."""
    return list(POSITION) if has_position(df) else []


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _below_common_folder(file: Column, least: Column, largest: Column) -> Column:
    """A file's path below the folder that all files share (which is the one that the first and last path share)."""
    shared = F.aggregate(
        F.arrays_zip(F.split(least, "/").alias("a"), F.split(largest, "/").alias("b")),
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("same")),
        lambda acc, x: F.struct((acc["n"] + F.when(acc["same"] & x["a"].eqNullSafe(x["b"]), F.length(x["a"]) + 1).otherwise(0)).alias("n"), (acc["same"] & x["a"].eqNullSafe(x["b"])).alias("same")),
        lambda acc: acc["n"],
    )
    # one file alone shares its whole path: its name is left
    cut = F.when(least == largest, F.length(least) - F.length(F.substring_index(least, "/", -1))).otherwise(shared)
    return F.substring(file, cut + 1, F.length(file))


def _scan(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``value, file, line_no`` of a text scan; the first line of a file is 0.

    Fails if the files change between the counting pass and the reading one.
    """
    scan = _scan(lines)
    blocks = scan.groupBy("path", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    ordered = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = _written(blocks.withColumn("before", F.coalesce(F.sum("n").over(ordered), F.lit(0).cast("long"))), "blocks")
    ends = starts.agg(F.min("path").alias("least"), F.max("path").alias("largest")).first()
    if ends["least"] is None:
        return scan.select("value", F.col("path").alias(FILE), F.col("place").alias(ROW))
    named = starts.select("path", "block", "first", "n", "before", _below_common_folder(F.col("path"), F.lit(ends["least"]), F.lit(ends["largest"])).alias(FILE))
    inside = F.col("place") - F.col("first")
    checked = F.when(inside.between(0, F.col("n") - 1), F.col("before") + inside).otherwise(F.raise_error(F.lit("an input file has changed while it was read")).cast("long"))
    return scan.join(named, ["path", "block"], "left").select("value", FILE, checked.alias(ROW))


def first_places(lines: DataFrame) -> DataFrame:
    """``path, place`` of the first line of every file."""
    scan = _scan(lines)
    first = F.min(F.when(F.col("block") == 0, F.col("place")))
    return scan.groupBy("path").agg(first.alias("place")).where("place IS NOT NULL")


def without_headers(lines: DataFrame, header: str) -> DataFrame:
    """``value`` of a text scan without the first line of every file (``each``) or of the first file (``first``).

    Lines are left out by their place alone; all others stay as they are, blank ones too.
    """
    heads = first_places(lines)
    if header == "first":
        heads = heads.agg(F.min_by("place", "path").alias("place")).where("place IS NOT NULL")
    return _scan(lines).join(_written(heads.select("place"), "headers"), "place", "left_anti").select("value")


def numbered_rows(table: DataFrame) -> DataFrame:
    """The rows of a parquet scan with ``file`` and ``line_no`` (its columns stay)."""
    path = F.col("_metadata.file_path")
    ends = table.agg(F.min(path).alias("least"), F.max(path).alias("largest")).first()
    file = path if ends["least"] is None else _below_common_folder(path, F.lit(ends["least"]), F.lit(ends["largest"]))
    return table.select("*", file.alias(FILE), F.col("_metadata.row_index").alias(ROW))


def rank(seed: int = 0) -> Column:
    """A pseudo-random rank of a row by its position: 16 bytes, equal on any split size."""
    return _hashed(F.lit(str(seed)), F.col(FILE), F.col(ROW).cast("string"))


def placed_rank(place: Column, seed: int = 0) -> Column:
    """As :func:`rank`, by partition and row number (``monotonically_increasing_id``): equal for one layout."""
    return _hashed(F.lit(str(seed)), place.cast("string"))


def _hashed(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", *parts).cast("binary")))
