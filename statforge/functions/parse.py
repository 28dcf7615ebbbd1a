"""Column expressions for positional text records.

The input records are text lines split by a delimiter, and numbers parsed with
strict (Java-style) grammars. Everything here returns a ``Column`` so it stays
inside Catalyst / whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delimiter regexes of the supported layouts (Java regex syntax, as Spark uses).
COMMA = ","
TAB = "\t"
WHITESPACE = r"\s+"

LAYOUTS = {"comma": COMMA, "tab": TAB, "whitespace": WHITESPACE}

# Integer text: optional sign, ASCII digits, nothing else (no blanks, no ".0").
_INT_TEXT = r"^[+-]?[0-9]+$"

# Non-finite literals Java accepts: exactly NaN / Infinity, optional sign,
# optional blanks (chars <= U+0020) around. Spark's cast also accepts "nan",
# "inf", "+inf", "INFINITY", ...; every finite result it gives is one Java
# gives too (it trims the same blanks and falls back to Java's parser).
_JAVA_NON_FINITE = r"^[\x00-\x20]*[+-]?(NaN|Infinity)[\x00-\x20]*$"
# Text that spells a non-finite value at all (no finite number contains these).
_NON_FINITE_WORD = r"(?i)(nan|inf)"

# Delimiters whose trailing runs can be stripped with a plain character trim.
_TRIM_SETS = {",": ",", "\t": "\t", r"\s+": " \t\n\x0b\f\r"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(line: Column | str, delimiter: str, keep_trailing_empty: bool = False) -> Column:
    """Split a line into an ``array<string>`` of fields.

    Matches ``String.split(regex)``: trailing empty fields are dropped (so the
    "last field" is the last non-empty one), a line of only delimiters gives no
    fields, and the empty line gives one empty field. A leading delimiter still
    gives an empty first field.
    """
    c = _col(line)
    if keep_trailing_empty:
        return F.split(c, delimiter)
    trim_set = _TRIM_SETS.get(delimiter)
    if trim_set is not None:
        # trimming costs as much as splitting, and few lines end with a delimiter
        ends = reduce(or_, [c.endswith(x) for x in trim_set])
        stripped = F.when(ends, F.rtrim(c, F.lit(trim_set))).otherwise(c)
    else:
        stripped = F.regexp_replace(c, f"(?:{delimiter})+$", "")
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, delimiter))
    )


def field(fields: Column | str, index: int, on_bad: str = "fail") -> Column:
    """0-based field access.

    ``on_bad="fail"`` raises for a row that is too short (the reference job
    fails on such a row); ``"null"`` / ``"drop"`` give NULL so the caller can
    filter the row out.
    """
    arr = _col(fields)
    value = F.get(arr, index)
    if on_bad == "fail":
        # split never yields NULL elements, so NULL here means "out of range"
        return F.coalesce(value, F.raise_error(F.lit(f"record has no field {index}")).cast("string"))
    if on_bad in ("null", "drop"):
        return value
    raise ValueError(f"on_bad must be 'fail', 'null' or 'drop', not {on_bad!r}")


def last_field(fields: Column | str) -> Column:
    """The last field, NULL for a record with no fields."""
    arr = _col(fields)
    return F.get(arr, F.size(arr) - 1)


def parse_int(text: Column | str, bits: int = 32) -> Column:
    """Strict integer parse: optional sign and ASCII digits only; NULL otherwise.

    ``try_cast`` runs first (out-of-range gives NULL); the pattern check only
    runs on values it accepted, to reject the blanks it trims.
    """
    c = _col(text)
    target = "int" if bits == 32 else "bigint"
    v = c.try_cast(target)
    return F.when(v.isNotNull() & c.rlike(_INT_TEXT), v)


def parse_long(text: Column | str) -> Column:
    return parse_int(text, bits=64)


def parse_double(text: Column | str) -> Column:
    """Strict floating-point parse with Java's grammar; NULL when it fails.

    ``try_cast`` does the parsing. It is more lenient than Java only for the
    non-finite spellings, so the pattern checks run only when the result is
    NaN or infinite (an overflow such as ``1e999`` is a valid infinity).
    """
    c = _col(text)
    d = c.try_cast("double")
    finite = ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))
    return (
        F.when(d.isNull(), F.lit(None).cast("double"))
        .when(finite, d)
        .when(~c.rlike(_NON_FINITE_WORD) | c.rlike(_JAVA_NON_FINITE), d)
    )


def or_fail(raw: Column, parsed: Column, what: str | Column, cast: str = "double") -> Column:
    """``parsed``, or a job failure when ``raw`` is present but did not parse.

    ``parsed`` is referenced once, so the parse is not duplicated in the plan.
    """
    said = F.lit(f"{what} is not a number: ") if isinstance(what, str) else F.concat(what, F.lit(" is not a number: "))
    return F.coalesce(
        parsed,
        F.when(raw.isNotNull(), F.raise_error(F.concat(said, raw))).cast(cast),
    )


def parse_double_or_nan(text: Column | str) -> Column:
    """Parse a double; unparsable text becomes NaN and the row is kept."""
    return F.coalesce(parse_double(text), F.lit(float("nan")))


def nan_to_null(c: Column | str) -> Column:
    """NaN shown as NULL (for hashing / SQL comparison)."""
    x = _col(c)
    return F.when(~F.isnan(x), x)
