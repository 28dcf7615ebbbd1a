"""Nearest centroid: ties, NaN, infinities, widths."""

from __future__ import annotations

from pyspark.sql import functions as F

from statforge.functions.vectors import nearest_centroid_array


def _nearest(spark, points, centers):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "i INT, v ARRAY<DOUBLE>")
    rows = df.select("i", nearest_centroid_array(F.col("v"), centers).alias("c")).collect()
    return [c for _, c in sorted(tuple(r) for r in rows)]


def test_ties_and_nan_go_to_the_lowest_index(spark):
    pts = [[0.0, 0.0], [1.0, 0.0], [5.0, 5.0], [float("nan"), 1.0], [2.6, 2.4]]
    assert _nearest(spark, pts, [[0.0, 0.0], [2.0, 0.0], [5.0, 5.0]]) == [0, 0, 2, 0, 1]


def test_infinite_centroid_is_a_literal_like_others(spark):
    assert _nearest(spark, [[1.0, 1.0]], [[float("inf"), 0.0], [2.0, 2.0]]) == [1]


def test_many_wide_centroids(spark):
    centers = [[float(k)] * 60 for k in range(40)]
    assert _nearest(spark, [[7.2] * 60, [38.9] * 60], centers) == [7, 39]
