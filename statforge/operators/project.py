"""Projections over positional records."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.functions.parse import field, or_fail, parse_double


def _arr(fields: Column | str) -> Column:
    return F.col(fields) if isinstance(fields, str) else fields


def join_fields(fields: Column | str, positions: Sequence[int], sep: str = "\t", on_bad: str = "fail") -> Column:
    """The listed fields joined into one text value (reordered projection as a line).

    NULL if any of them is missing, so a short record never gives a shorter value.
    """
    arr = _arr(fields)
    parts: list[Column] = []
    for i in positions:
        parts += [F.lit(sep), field(arr, i, on_bad)] if parts else [field(arr, i, on_bad)]
    return F.concat(*parts)


def composite_key(fields: Column | str, positions: Sequence[int], sep: str = ", ", on_bad: str = "fail") -> Column:
    """Group key made of several fields joined by ``sep``."""
    return join_fields(fields, positions, sep, on_bad)


def tagged_key(key: Column, tag: Column, sep: str = " | ") -> Column:
    """``"<key> | <tag>"`` composite key."""
    return F.concat_ws(sep, key, tag)


def signed_value(sign: Column, magnitude: Column, negative: str = "-") -> Column:
    """Apply a separate sign character to a magnitude."""
    return F.when(sign == F.lit(negative), -magnitude).otherwise(magnitude)


def feature_columns(
    fields: Column | str, var_indices: Sequence[int], parse=parse_double, on_bad: str = "fail"
) -> list[Column]:
    """One double per chosen column; a missing field gives NULL (short vector, P6).

    A present field that does not parse fails the job (``on_bad="fail"``) or
    gives NULL (``on_bad="null"``).
    """
    arr = _arr(fields)
    out = []
    for i in var_indices:
        raw = F.get(arr, i)
        value = parse(raw)
        if on_bad == "fail":
            value = or_fail(raw, value, f"field {i}")
        out.append(value)
    return out


def feature_array(fields: Column | str, var_indices: Sequence[int], parse=parse_double, on_bad: str = "fail") -> Column:
    """:func:`feature_columns` as one array; the expression stays small whatever the number of columns."""
    arr = _arr(fields)

    def value(i: Column) -> Column:
        raw = F.get(arr, i)
        parsed = parse(raw)
        return or_fail(raw, parsed, F.concat(F.lit("field "), i.cast("string"))) if on_bad == "fail" else parsed

    return F.transform(F.lit([int(i) for i in var_indices]), value)


def standardised_array(values: Column, var_indices: Sequence[int], means: Sequence[float], stds: Sequence[float]) -> Column:
    """:func:`standardise` for an array of the chosen columns."""
    check_moments(var_indices, means, stds)
    chosen = lambda xs: F.lit([float(xs[i]) for i in var_indices])
    centred = F.zip_with(values, chosen(means), lambda v, m: v - m)
    return F.zip_with(centred, chosen(stds), lambda v, s: v / s)


def check_moments(var_indices: Sequence[int], means: Sequence[float], stds: Sequence[float]) -> None:
    """Standardising by a zero, NaN or missing std would poison every distance."""
    for i in var_indices:
        if i >= len(means) or i >= len(stds):
            raise ValueError(f"no moments for column {i}")
        m, s = means[i], stds[i]
        if m is None or s is None or math.isnan(m) or math.isnan(s):
            raise ValueError(f"column {i} has NaN moments (text column?)")
        if s == 0:
            raise ValueError(f"column {i} is constant (std 0); drop it from the variables")


def standardise(
    values: Sequence[Column], var_indices: Sequence[int], means: Sequence[float], stds: Sequence[float]
) -> list[Column]:
    """``(x - mean[col]) / std[col]`` per chosen column, moments inlined as literals."""
    check_moments(var_indices, means, stds)
    return [
        (v - F.lit(float(means[i]))) / F.lit(float(stds[i]))
        for v, i in zip(values, var_indices)
    ]


def standardise_centers(
    centers: Sequence[Sequence[float]], var_indices: Sequence[int], means: Sequence[float], stds: Sequence[float]
) -> list[list[float]]:
    """Standardise raw-scale starting centroids once (P8); k x d values on the driver."""
    check_moments(var_indices, means, stds)
    return [[(c[j] - means[i]) / stds[i] for j, i in enumerate(var_indices)] for c in centers]


def matching(texts: Sequence[Column], substrings: Sequence[str]) -> Column:
    """The substrings found (case-insensitive) in any of ``texts``, as an array.

    A text holding two substrings gives both; a substring found in two of the
    texts is given once. ``filter`` over a literal array: map-side, no join.
    """
    lowered = [F.lower(t) for t in texts]

    def found(s: Column) -> Column:
        cond = None
        for t in lowered:
            c = t.contains(s)
            cond = c if cond is None else (cond | c)
        return F.coalesce(cond, F.lit(False))

    return F.filter(F.array(*[F.lit(s) for s in substrings]), found)


def explode_matches(df: DataFrame, texts: Sequence[Column], substrings: Sequence[str], out: str = "substring") -> DataFrame:
    """One output row per substring found in any of ``texts``."""
    return df.withColumn(out, F.explode(matching(texts, substrings)))
