"""Row predicates (F1-F9). Each returns a boolean ``Column`` for ``where``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from statforge.functions.parse import last_field, parse_double_or_nan


def last_field_equals_ci(fields: Column | str, value: str = "false") -> Column:
    """Last (non-empty) field equals ``value``, ignoring case (F1)."""
    arr = F.col(fields) if isinstance(fields, str) else fields
    return F.coalesce(F.lower(last_field(arr)) == F.lit(value.lower()), F.lit(False))


def in_list(c: Column, values: Sequence) -> Column:
    """Value in a fixed list (F2)."""
    return c.isin(list(values))


def not_sentinel(c: Column, sentinel=9999) -> Column:
    """Missing-value sentinel test."""
    return c != F.lit(sentinel)


def in_closed_range(c: Column, low, high) -> Column:
    """``low <= c <= high``."""
    return c.between(low, high)


def within_upper_bounds(pairs: Sequence[tuple[Column, float]]) -> Column:
    """Every value at most its bound; NaN never exceeds a bound."""
    cond = F.lit(True)
    for value, bound in pairs:
        cond = cond & ((value <= F.lit(float(bound))) | F.isnan(value))
    return cond


def equals_and_member(equal: Sequence[tuple[Column, str]], member: Sequence[tuple[Column, Sequence[str]]]) -> Column:
    """String equalities and memberships, all ANDed."""
    cond = F.lit(True)
    for c, v in equal:
        cond = cond & (c == F.lit(v))
    for c, vs in member:
        cond = cond & c.isin(list(vs))
    return F.coalesce(cond, F.lit(False))


def contains_ci(text: Column, sub: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(text).contains(sub.lower())


def parsed(*values: Column) -> Column:
    """All parses succeeded (F8): unparsable numbers drop the row."""
    cond = F.lit(True)
    for v in values:
        cond = cond & v.isNotNull()
    return cond


def parse_or_nan(text: Column) -> Column:
    """Unparsable numbers become NaN, the row stays."""
    return parse_double_or_nan(text)
