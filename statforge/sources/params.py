"""Parameter files: centroid matrix, variable list, moments.

These files are small by construction (k lines, one line, two lines). They are
read with ``wholetext`` so line order is kept, parsed with Spark expressions,
and their values (as many as the caller's k, d and record width say) are
fetched once to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statforge.functions.parse import WHITESPACE, parse_double, split_fields


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``DataFrame[line_no, line]``: non-blank lines numbered in file-name then
    line order (a directory of part files reads as one file).

    Each file is one ``wholetext`` row; lines are numbered within it by
    ``posexplode`` and shifted by the number of lines in the files before it,
    a running sum over one row per file that is joined back by file name.
    """
    files = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    exploded = files.select("file", F.posexplode(F.split(F.col("value"), "\r?\n")).alias("pos", "line"))
    exploded = exploded.where(F.trim(F.col("line")) != "")
    exploded = exploded.select("file", F.row_number().over(Window.partitionBy("file").orderBy("pos")).alias("n"), "line")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    counts = exploded.groupBy("file").agg(F.count(F.lit(1)).alias("lines"))
    offsets = counts.select("file", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("offset"))
    return exploded.join(offsets, "file").select((F.col("offset") + F.col("n") - 1).alias("line_no"), "line")


def _numbers(line_col: str = "line"):
    """``array<double>`` of the blank-separated numbers of a line; bad text fails."""
    parts = split_fields(F.trim(F.col(line_col)), WHITESPACE)
    return F.transform(
        parts,
        lambda s: F.coalesce(parse_double(s), F.raise_error(F.concat(F.lit("not a number: "), s)).cast("double")),
    )


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Centroid matrix file -> ``DataFrame[cluster INT, center ARRAY<DOUBLE>]``.

    Line i (0-based) is cluster i. A NaN coordinate is rejected: it would
    silently change which centroid is nearest.
    """
    rows = _numbered_lines(spark, path).select(
        F.col("line_no").cast("int").alias("cluster"), _numbers().alias("center")
    )
    return rows.withColumn(
        "center",
        F.when(F.exists("center", lambda x: F.isnan(x)), F.raise_error(F.lit("NaN in a centroid"))).otherwise(
            F.col("center")
        ),
    )


def centroids_to_list(centroids: DataFrame) -> list[list[float]]:
    """Fetch a centroid frame (``cluster``, ``center``) as a k x d list, in cluster order."""
    rows = centroids.select("cluster", "center").orderBy("cluster").collect()
    centers = [[float(x) for x in r["center"]] for r in rows]
    widths = {len(c) for c in centers}
    if len(widths) > 1:
        raise ValueError(f"centroids of different widths: {sorted(widths)}")
    return centers


def centroids_frame(spark: SparkSession, centers: Sequence[Sequence[float]]) -> DataFrame:
    """k x d list -> ``DataFrame[cluster, center]`` (k rows)."""
    data = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]
    return spark.createDataFrame(data, "cluster INT, center ARRAY<DOUBLE>")


def read_variables(spark: SparkSession, path: str) -> list[int]:
    """Variable list file: the 0-based column indices on its first line."""
    first = _numbered_lines(spark, path).where(F.col("line_no") == 0).select("line").first()
    if first is None:
        return []
    return [int(tok) for tok in first[0].split()]


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    """Moments file (line 1 means, line 2 standard deviations) ->
    ``DataFrame[col_idx INT, mean DOUBLE, std DOUBLE]``. NaN is allowed."""
    lines = _numbered_lines(spark, path).where(F.col("line_no") < 2).select("line_no", _numbers().alias("v"))
    packed = lines.agg(
        F.first(F.when(F.col("line_no") == 0, F.col("v")), ignorenulls=True).alias("mean"),
        F.first(F.when(F.col("line_no") == 1, F.col("v")), ignorenulls=True).alias("std"),
    )
    return packed.select(F.posexplode(F.arrays_zip("mean", "std")).alias("col_idx", "ms")).select(
        F.col("col_idx").cast("int"), F.col("ms.mean").alias("mean"), F.col("ms.std").alias("std")
    )


def moments_to_lists(moments: DataFrame) -> tuple[list[float], list[float]]:
    """Fetch a moments frame as (means, stds) lists indexed by column position."""
    rows = moments.select("col_idx", "mean", "std").orderBy("col_idx").collect()
    width = (rows[-1]["col_idx"] + 1) if rows else 0
    means = [float("nan")] * width
    stds = [float("nan")] * width
    for r in rows:
        means[r["col_idx"]] = float("nan") if r["mean"] is None else float(r["mean"])
        stds[r["col_idx"]] = float("nan") if r["std"] is None else float(r["std"])
    return means, stds
