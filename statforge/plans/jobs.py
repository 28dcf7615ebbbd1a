"""The summary-statistics and clustering jobs, each one DataFrame plan.

Every job takes line frames (``DataFrame[value: string]``, the shape of
``spark.read.text``) plus its parameters, and returns a lazy DataFrame (or,
for the iterative fits, a small result object). Defaults reproduce the
original record layouts; every position and constant is a parameter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.functions.parse import (
    COMMA,
    TAB,
    WHITESPACE,
    field,
    or_fail,
    parse_double,
    parse_int,
    parse_long,
)
from statforge.operators import aggregate as agg
from statforge.operators import kmeans as km
from statforge.operators import order
from statforge.operators.counted import DropCounts, kept_rows
from statforge.operators import predicates as pred
from statforge.operators import project as proj
from statforge.sources.position import carried
from statforge.sources.text import fixed_width, parse_delimited, with_columns_once

#: Above this many variables the feature vector is one array expression (unrolled code would be too large to compile).
WIDE_FEATURES = 32

# ---------------------------------------------------------------------------
# Default record layouts and constants of the original jobs.
# ---------------------------------------------------------------------------
FLAG_VALUE_INDEX = 3
FLAG_KEY_INDICES = (29, 30, 31, 32)
FLAG_KEEP = "false"

STATION_LAYOUT = {"year": (15, 19), "sign": (87, 88), "reading": (88, 92), "quality": (92, 93)}
STATION_QUALITY = (0, 1, 4, 5, 9)
STATION_MISSING = 9999
STATION_FLOOR = -9999

SONG_TITLE, SONG_ARTIST, SONG_DURATION, SONG_YEAR = 1, 2, 3, 165
SONG_YEARS = (2000, 2010)

NGRAM_SUBSTRINGS = ("nu", "die", "kla")

SUBSET_BOUNDS = {18: 500.0, 23: 1000.0}
SUBSET_EQUALS = {6: "I"}
SUBSET_MEMBER = {13: ("Internal Medicine", "Family Practice")}


def _fields(lines: DataFrame, delimiter: str, column: str = "value") -> DataFrame:
    return parse_delimited(lines, delimiter, column=column, out="fields")


def _fail_unparsed(raw, parsed, what: str, cast: str = "double"):
    """Parsed value, or a job failure when present text does not parse."""
    return or_fail(raw, parsed, what, cast)


# ---------------------------------------------------------------------------
# Grouped mean of rows whose flag is false (comma records).
# ---------------------------------------------------------------------------
def flag_group_mean(
    lines: DataFrame,
    value_index: int = FLAG_VALUE_INDEX,
    key_indices: Sequence[int] = FLAG_KEY_INDICES,
    keep_flag: str = FLAG_KEEP,
    delimiter: str = COMMA,
    on_bad: str = "fail",
    counts: DropCounts | None = None,
) -> DataFrame:
    """``DataFrame[group_key, mean_value]``: mean of one field per composite key,
    over records whose last field equals ``keep_flag`` (any case).

    The key is read before the flag is looked at, so a record too short for its
    key fails the job (or is dropped) whatever its flag says.
    """
    rows = with_columns_once(_fields(lines, delimiter), {"group_key": proj.composite_key("fields", key_indices, ", ", on_bad)})
    rows = kept_rows(rows, {"too short for its key": F.col("group_key").isNotNull(), "flag": pred.last_field_equals_ci("fields", keep_flag)}, counts)
    raw = field("fields", value_index, on_bad)
    value = parse_double(raw)
    if on_bad == "fail":
        value = _fail_unparsed(raw, value, f"field {value_index}")
    keyed = rows.select("group_key", value.alias("v"))
    if on_bad == "drop":
        keyed = kept_rows(keyed, {"value is not a number": pred.parsed(F.col("v"))}, counts, "flagged records")
    return order.sorted_partitions(agg.grouped_mean(keyed, "group_key", "v", alias="mean_value"), "group_key")


# ---------------------------------------------------------------------------
# Yearly maximum of fixed-width station readings.
# ---------------------------------------------------------------------------
def station_year_max(
    lines: DataFrame,
    layout: Mapping[str, tuple[int, int]] = STATION_LAYOUT,
    quality: Sequence[int] = STATION_QUALITY,
    missing: int = STATION_MISSING,
    floor: int = STATION_FLOOR,
    on_bad: str = "fail",
    counts: DropCounts | None = None,
) -> DataFrame:
    """``DataFrame[year, max_value]``: signed reading, quality in the list, not
    the missing sentinel; the maximum starts at ``floor``."""
    cut = fixed_width(lines, layout, on_bad=on_bad)
    reading = parse_int(F.col("reading"))
    q = parse_int(F.col("quality"))
    if on_bad == "fail":
        reading = _fail_unparsed(F.col("reading"), reading, "reading", "int")
        q = _fail_unparsed(F.col("quality"), q, "quality", "int")
    signed = proj.signed_value(F.col("sign"), reading)
    rows = cut.select(F.col("year"), signed.alias("t"), q.alias("q"))
    if on_bad == "drop":
        rows = kept_rows(rows, {"reading is not an integer": pred.parsed(F.col("t")), "quality is not an integer": pred.parsed(F.col("q"))}, counts)
    rows = rows.where(pred.not_sentinel(F.col("t"), missing) & pred.in_list(F.col("q"), quality))
    return order.sorted_partitions(agg.grouped_max(rows, "year", "t", floor=floor, alias="max_value"), "year")


# ---------------------------------------------------------------------------
# Map-only projection of records in a year range.
# ---------------------------------------------------------------------------
def year_range_projection(
    lines: DataFrame,
    title: int = SONG_TITLE,
    artist: int = SONG_ARTIST,
    duration: int = SONG_DURATION,
    year: int = SONG_YEAR,
    years: tuple[int, int] = SONG_YEARS,
    delimiter: str = COMMA,
    on_bad: str = "fail",
    counts: DropCounts | None = None,
) -> DataFrame:
    """``DataFrame[artist, duration, title, year]`` (text fields, reordered) of
    records whose year parses as an integer within ``years``. No shuffle."""
    rows = _fields(lines, delimiter)
    y_text = field("fields", year, on_bad)
    y = parse_int(y_text)
    kept = kept_rows(rows, {"year is not an integer": pred.parsed(y), "year out of range": pred.in_closed_range(y, years[0], years[1])}, counts)
    return kept.select(
        field("fields", artist, on_bad).alias("artist"),
        field("fields", duration, on_bad).alias("duration"),
        field("fields", title, on_bad).alias("title"),
        y_text.alias("year"),
    )


def projection_lines(projected: DataFrame) -> DataFrame:
    """Tab-joined output lines of ``year_range_projection``."""
    return projected.select(F.concat_ws("\t", "artist", "duration", "title", "year").alias("value"))


# ---------------------------------------------------------------------------
# Grouped maximum floored at 0, optionally range-partitioned by first char.
# ---------------------------------------------------------------------------
def key_values(lines: DataFrame, key: int, value: int, delimiter: str = COMMA, on_bad: str = "fail", counts: DropCounts | None = None) -> DataFrame:
    """(key text, parsed double) pairs; records whose value does not parse are dropped."""
    rows = _fields(lines, delimiter)
    pairs = rows.select(field("fields", key, on_bad).alias("key"), parse_double(field("fields", value, on_bad)).alias("v"))
    return kept_rows(pairs, {"value is not a number": pred.parsed(F.col("v")), "no key": F.col("key").isNotNull()}, counts)


def group_max_floor(
    lines: DataFrame, key: int = SONG_ARTIST, value: int = SONG_DURATION, delimiter: str = COMMA, on_bad: str = "fail", counts: DropCounts | None = None
) -> DataFrame:
    """``DataFrame[key, max_value]``: per-key maximum, at least 0, NaN ignored."""
    return agg.grouped_max_floor_zero(key_values(lines, key, value, delimiter, on_bad, counts), "key", "v", alias="max_value")


def range_partitioned_max(
    lines: DataFrame,
    key: int = SONG_ARTIST,
    value: int = SONG_DURATION,
    break_points: Sequence[str] = order.DEFAULT_BREAK_POINTS,
    num_partitions: int = order.DEFAULT_RANGE_PARTITIONS,
    delimiter: str = COMMA,
    on_bad: str = "fail",
    parts_per_bucket: int = order.DEFAULT_PARTS_PER_BUCKET,
    counts: DropCounts | None = None,
) -> DataFrame:
    """``DataFrame[key, max_value, bucket]``: each range bucket on a run of
    consecutive partitions in key order (``parts_per_bucket=1``: partition b
    holds exactly bucket b).

    The aggregation runs first at full parallelism; only one row per key then
    moves to the range partitions.
    """
    maxima = group_max_floor(lines, key, value, delimiter, on_bad, counts)
    return order.range_partitioned(maxima, "key", break_points, num_partitions, parts_per_bucket=parts_per_bucket)


# ---------------------------------------------------------------------------
# n-gram substring means and volume standard deviation (two sources).
# ---------------------------------------------------------------------------
def _ngram_rows(lines: DataFrame, words: int, substrings: Sequence[str] | None, on_bad: str) -> DataFrame:
    """Common shape of a unigram (``words=1``) or bigram (``words=2``) source."""
    rows = _fields(lines, WHITESPACE)
    mode = on_bad
    if substrings is not None:
        texts = [field("fields", i, "null") for i in range(words)]
        if words > 1 and on_bad == "fail":
            # every word must exist once a record is examined
            texts = [field("fields", i, "fail") if i > 0 else t for i, t in enumerate(texts)]
        # found once; year and volumes are looked at (and missed) only in records with a match
        rows = with_columns_once(rows, {"found": proj.matching(texts, substrings)}).where(F.size("found") > 0)
        if on_bad == "fail":
            mode = "null"

    def read(index: int):
        value = field("fields", index, mode)
        if mode == on_bad:
            return value
        # filters on these values are planned below the one on "found", so the failure is tied to it here
        missing = F.when(F.size("found") > 0, F.raise_error(F.lit(f"record has no field {index}")).cast("string"))
        return F.coalesce(value, missing)

    columns = [F.explode("found").alias("substring")] if substrings is not None else []
    return rows.select(*columns, read(words).alias("year_text"), read(words + 2).alias("volumes_text"))


def ngram_substring_mean(
    unigrams: DataFrame,
    bigrams: DataFrame,
    substrings: Sequence[str] = NGRAM_SUBSTRINGS,
    on_bad: str = "fail",
    counts: DropCounts | None = None,
) -> DataFrame:
    """``DataFrame[tag_key, mean_volumes]`` with ``tag_key = "<year> | <substring>"``.

    A unigram counts once per substring its word holds; a bigram once per
    substring either word holds. Year and volumes must parse as integers; the
    year is grouped as written. ``counts`` counts matches, by source.
    """
    parts = []
    for lines, words, source in ((unigrams, 1, "unigrams"), (bigrams, 2, "bigrams")):
        r = _ngram_rows(lines, words, substrings, on_bad)
        year = parse_int(F.col("year_text"))
        vol = parse_int(F.col("volumes_text"))
        parts.append(
            kept_rows(r, {"year is not an integer": pred.parsed(year), "volumes are not an integer": pred.parsed(vol)}, counts, source).select(
                proj.tagged_key(F.col("year_text"), F.col("substring")).alias("tag_key"),
                vol.cast("double").alias("volumes"),
            )
        )
    union = parts[0].unionByName(parts[1])
    return order.sorted_partitions(agg.grouped_mean(union, "tag_key", "volumes", alias="mean_volumes"), "tag_key")


def ngram_volume_stddev(unigrams: DataFrame, bigrams: DataFrame, on_bad: str = "fail", counts: DropCounts | None = None) -> DataFrame:
    """``DataFrame[stddev]``: population standard deviation of the volumes of
    both sources together; one row, none for empty input."""
    parts = []
    for lines, index, source in ((unigrams, 3, "unigrams"), (bigrams, 4, "bigrams")):
        rows = _fields(lines, WHITESPACE)
        vol = parse_long(field("fields", index, on_bad))
        parts.append(kept_rows(rows.select(vol.alias("volumes")), {"volumes are not an integer": pred.parsed(F.col("volumes"))}, counts, source))
    union = parts[0].unionByName(parts[1])
    return agg.global_stddev(union, "volumes", alias="stddev")


# ---------------------------------------------------------------------------
# Whole-table profile and row subset (tab records).
# ---------------------------------------------------------------------------
def column_moments(
    lines: DataFrame,
    width: int | None = None,
    delimiter: str = TAB,
    on_bad: str = "fail",
    columns: Sequence[int] | None = None,
    counts: DropCounts | None = None,
) -> DataFrame:
    """``DataFrame[col_idx, mean, std]`` over every column (or the listed
    ones); text fields count as NaN, and ``counts`` says how many did."""
    rows = _fields(lines, delimiter)
    if counts is not None:
        width = width if width is not None else (rows.select(F.size("fields")).first() or [0])[0]
        listed = F.col("fields") if columns is None else F.filter(F.transform(F.lit([int(c) for c in columns]), lambda i: F.get("fields", i)), lambda x: x.isNotNull())
        rows = counts.note(rows, {"fields that are not numbers": F.size(F.filter(listed, lambda x: parse_double(x).isNull()))})
    return agg.column_profile(rows, "fields", width, on_bad, columns)


def subset_records(
    lines: DataFrame,
    bounds: Mapping[int, float] = SUBSET_BOUNDS,
    equals: Mapping[int, str] = SUBSET_EQUALS,
    member: Mapping[int, Sequence[str]] = SUBSET_MEMBER,
    delimiter: str = TAB,
    on_bad: str = "fail",
) -> DataFrame:
    """``DataFrame[value, fields]``: records within the numeric bounds (NaN passes)
    and with the listed string values, with their fields (and positions, if known) for a
    next step. Map-only."""
    rows = _fields(lines, delimiter)
    bound_pairs = []
    for i, b in bounds.items():
        raw = field("fields", i, on_bad)
        v = parse_double(raw)
        if on_bad == "fail":
            v = _fail_unparsed(raw, v, f"field {i}")
        bound_pairs.append((v, b))
    cond = pred.within_upper_bounds(bound_pairs) & pred.equals_and_member(
        [(field("fields", i, on_bad), v) for i, v in equals.items()],
        [(field("fields", i, on_bad), vs) for i, vs in member.items()],
    )
    return rows.where(F.coalesce(cond, F.lit(False))).select("value", "fields", *carried(rows))


def subset_rows(lines: DataFrame, *args, **kwargs) -> DataFrame:
    """Whole lines (``DataFrame[value]``) of :func:`subset_records`."""
    return subset_records(lines, *args, **kwargs).select("value")


# ---------------------------------------------------------------------------
# k-means on raw or standardised columns, and cluster assignment.
# ---------------------------------------------------------------------------
def feature_frame(
    lines: DataFrame,
    variables: Sequence[int],
    delimiter: str,
    moments: tuple[Sequence[float], Sequence[float]] | None = None,
    keep: Mapping[str, Column] | None = None,
    on_bad: str = "fail",
) -> tuple[DataFrame, km.Features]:
    """The chosen columns (standardised when ``moments`` is given) as one array ``x``.

    ``keep`` names further columns, expressions over ``value`` and ``fields``, so
    that what else a job needs of a line comes from the same split.
    """
    rows = _fields(lines, delimiter)
    kept = [c.alias(n) for n, c in (keep or {}).items()]
    if len(variables) > WIDE_FEATURES:
        vector = proj.feature_array("fields", variables, on_bad=on_bad)
        if moments is not None:
            vector = proj.standardised_array(vector, variables, moments[0], moments[1])
    else:
        values = proj.feature_columns("fields", variables, on_bad=on_bad)
        if moments is not None:
            values = proj.standardise(values, variables, moments[0], moments[1])
        vector = F.array(*values)
    return rows.select(*kept, vector.alias("x")), km.Features(array="x", width=len(variables))


def kmeans_raw(
    lines: DataFrame,
    init_centers: Sequence[Sequence[float]],
    variables: Sequence[int],
    max_iter: int = km.RAW_MAX_ITER,
    tol: float = km.TOLERANCE,
    delimiter: str = WHITESPACE,
    state: str | None = None,
) -> km.KMeansResult:
    """k-means on raw columns; stop when no coordinate moves more than ``tol``."""
    data, features = feature_frame(lines, variables, delimiter)
    return km.fit(data, features, init_centers, max_iter=max_iter, tol=tol, rule="max_abs", state=state)


def kmeans_standardised(
    lines: DataFrame,
    init_centers_raw: Sequence[Sequence[float]],
    variables: Sequence[int],
    means: Sequence[float],
    stds: Sequence[float],
    max_iter: int,
    tol: float = km.TOLERANCE,
    delimiter: str = TAB,
    state: str | None = None,
) -> km.KMeansResult:
    """k-means on standardised columns; the raw starting centroids are
    standardised once; stop when every centroid's squared move is <= ``tol``."""
    data, features = feature_frame(lines, variables, delimiter, moments=(means, stds))
    start = proj.standardise_centers(init_centers_raw, variables, means, stds)
    return km.fit(data, features, start, max_iter=max_iter, tol=tol, rule="squared_shift", state=state)


def assign_clusters(
    lines: DataFrame,
    centers: Sequence[Sequence[float]],
    variables: Sequence[int],
    moments: tuple[Sequence[float], Sequence[float]] | None = None,
    delimiter: str = TAB,
    keep: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``DataFrame[cluster, value]``: every original line with its cluster (or, with
    ``keep``, these expressions over ``value`` and ``fields`` instead of the line). Map-only."""
    kept = {"value": F.col("value")} if keep is None else keep
    data, features = feature_frame(lines, variables, delimiter, moments=moments, keep=kept)
    return km.assign(data, features, centers).select("cluster", *kept)


def assignment_lines(assigned: DataFrame) -> DataFrame:
    """``cluster<TAB>line`` output of ``assign_clusters``."""
    return assigned.select(F.concat_ws("\t", F.col("cluster").cast("string"), F.col("value")).alias("value"))
