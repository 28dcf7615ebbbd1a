"""Nearest-centroid expression for clustering.

Centroids arrive as Python lists (k x d values, bounded by the parameters) and
are inlined as one literal, so the nearest-centroid step is map-side: no join, no
shuffle. The general form is over an ``array<double>`` column: the expression stays small
whatever k and d are. A few short centroids are written out over one double column a
coordinate instead, which Spark compiles (functions over arrays are interpreted a row);
both forms give the same values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance(vec: Column, center: Column) -> Column:
    """Euclidean distance of two ``array<double>`` columns, summed from left to right."""
    return F.sqrt(F.aggregate(F.zip_with(vec, center, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x))


def _distances(vec: Column, centers: Sequence[Sequence[float]]) -> Column:
    lit_centers = F.lit([[float(x) for x in c] for c in centers])  # infinities survive as array elements
    return F.transform(lit_centers, lambda c: distance(vec, c))


def _first_least(dists: Column) -> Column:
    return (F.array_position(dists, F.array_min(dists)) - F.lit(1)).cast("int")


def nearest_centroid_array(vec: Column, centers: Sequence[Sequence[float]]) -> Column:
    """Nearest centroid for an ``array<double>`` vector.

    All centroids travel as one ``array<array<double>>`` literal, so the
    expression stays small whatever k and the width are: one distance per
    centroid by ``transform``, then the first position of the minimum (ties
    to the lowest index; an all-NaN row gets 0).
    """
    return _first_least(_distances(vec, centers))


def two_nearest(vec: Column, centers: Sequence[Sequence[float]]) -> Column:
    """``struct(cluster, upper, lower)``: the nearest centroid as above, its distance, and the distance
    of the next one (infinite if there is none). The distances are computed once."""
    held = F.transform(F.array(_distances(vec, centers)), _ranked)
    return F.get(held, 0)


def _ranked(dists: Column) -> Column:
    ordered = F.array_sort(dists)
    return F.struct(_first_least(dists).alias("cluster"), F.get(ordered, 0).alias("upper"), F.coalesce(F.get(ordered, 1), F.lit(float("inf"))).alias("lower"))


def distance_columns(values: Sequence[Column], center: Sequence[Column]) -> Column:
    """:func:`distance` written out over single columns, summed in the same order."""
    total = None
    for v, c in zip(values, center, strict=True):
        term = (v - c) * (v - c)
        total = term if total is None else total + term
    return F.sqrt(total)


def distances_columns(values: Sequence[Column], centers: Sequence[Sequence[float]]) -> list[Column]:
    """The distances to all centroids, a column each."""
    return [distance_columns(values, [F.lit(float(x)) for x in c]) for c in centers]


def least_of(dists: Sequence[Column]) -> Column:
    return F.least(*dists) if len(dists) > 1 else dists[0]


def first_least_columns(dists: Sequence[Column]) -> Column:
    """Number of the first least of single columns (NaN: greatest, and equal to itself)."""
    least, found = least_of(dists), None
    for i, d in enumerate(dists[:-1]):
        found = F.when(d == least, F.lit(i)) if found is None else found.when(d == least, F.lit(i))
    last = F.lit(len(dists) - 1)
    return last if found is None else found.otherwise(last)
