"""Column-level building blocks (all JVM-side expressions)."""

from statforge.functions.parse import (
    COMMA,
    LAYOUTS,
    TAB,
    WHITESPACE,
    field,
    last_field,
    nan_to_null,
    parse_double,
    parse_double_or_nan,
    parse_int,
    parse_long,
    split_fields,
)
from statforge.functions.vectors import nearest_centroid_array

__all__ = [
    "COMMA",
    "LAYOUTS",
    "TAB",
    "WHITESPACE",
    "field",
    "last_field",
    "nan_to_null",
    "nearest_centroid_array",
    "parse_double",
    "parse_double_or_nan",
    "parse_int",
    "parse_long",
    "split_fields",
]
