"""Registered queries: every job run over the test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names and types match its SQL oracle (``statforge.plans.oracles``). Doubles
that depend on summation order are rounded in both (see the rounding note
below), so the comparison does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statforge.functions.parse import TAB, WHITESPACE, field, nan_to_null, parse_double, parse_int, parse_long
from statforge.operators import kmeans as km
from statforge.operators.counted import DropCounts
from statforge.plans import jobs, tables
from statforge.plans.clustering import run_clustering
from statforge.session import scratch_path
from statforge.sinks import key_value_lines, single_column_lines, write_centroids, write_lines, write_moments
from statforge.sources import read_centroids, read_lines, read_moments, read_table, read_variables
from statforge.sources.params import centroids_frame, moments_to_lists
from statforge.sources.text import cut_fields, parse_delimited, redelimit

# Parameters of the test queries.
#
# Rounding: means of integer-valued inputs are exact sums divided by a count,
# bit-identical in any engine, so they are not rounded (rounding could only
# add differences). Profile means of two-decimal inputs terminate by the 7th
# decimal at sf0.01, so they are rounded at 8 places, away from any tie.
# Irrational results (std devs, standardised values, centroids) use 6 places.
FLAG_KEYS = (4, 5, 6, 7)
SONG_YEARS = (1997, 1999)
BREAK_POINTS = ("f", "k", "p", "u")
SUBSTRINGS = ("ol", "ar", "in")
SUBSET_BOUNDS = {4: 25.0, 5: 50000.0}
SUBSET_EQUALS = {9: "O"}
SUBSET_MEMBER = {8: ("A", "R")}
RAW_VARIABLES = (2, 3, 4)  # quantity, discount, tax of the blank-separated lineitem records
STD_VARIABLES = (4, 5, 6)  # quantity, extendedprice, discount of the tab lineitem records
K = 4
STD_MAX_ITER = 20
CLUSTER_K = 4
SUBSET_CLUSTER_K = 3
EMBED_K = 5
SAMPLE_K = 10
LINEITEM_WIDTH = len(tables.LINEITEM_COLUMNS)  # fields of the tab rendering (no width probe needed)


def _r(c, places: int = 6):
    return F.round(c, places)


# --------------------------------------------------------------------------- summary jobs
def csv_flag_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.flag_group_mean(tables.lineitem_flag_lines(spark, sf_dir), value_index=3, key_indices=FLAG_KEYS)


def fixed_width_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.station_year_max(tables.lineitem_station_lines(spark, sf_dir))


def year_range_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.year_range_projection(
        tables.orders_song_lines(spark, sf_dir), title=1, artist=2, duration=3, year=4, years=SONG_YEARS
    )


def group_max_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.group_max_floor(tables.customer_balance_lines(spark, sf_dir), key=2, value=3)


def range_bucket_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jobs.range_partitioned_max(tables.part_price_lines(spark, sf_dir), key=2, value=3, break_points=BREAK_POINTS)
    return out.select("key", "max_value", "bucket")


def substring_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jobs.ngram_substring_mean(
        tables.customer_unigram_lines(spark, sf_dir, short=True), tables.part_bigram_lines(spark, sf_dir), SUBSTRINGS
    )
    return out


def union_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jobs.ngram_volume_stddev(tables.customer_unigram_lines(spark, sf_dir), tables.part_bigram_lines(spark, sf_dir))
    return out.select(_r(F.col("stddev")).alias("stddev"))


def _profile_long(moments: DataFrame) -> DataFrame:
    return moments.select(
        F.col("col_idx").cast("int").alias("col_idx"),
        _r(nan_to_null("mean"), 8).alias("mean"),
        _r(nan_to_null("std")).alias("std"),
    )


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_long(jobs.column_moments(tables.lineitem_tab_lines(spark, sf_dir), width=LINEITEM_WIDTH))


def _subset_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.subset_rows(
        tables.lineitem_tab_lines(spark, sf_dir), bounds=SUBSET_BOUNDS, equals=SUBSET_EQUALS, member=SUBSET_MEMBER
    )


def row_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subset_lines(spark, sf_dir)


# --------------------------------------------------------------------------- standardise / k-means
def _lineitem_moments(spark: SparkSession, sf_dir: str):
    """Moments of the clustering variables (one pass, three columns)."""
    return moments_to_lists(jobs.column_moments(tables.lineitem_tab_lines(spark, sf_dir), width=LINEITEM_WIDTH, columns=STD_VARIABLES))


def _keys() -> dict:
    """The line's key as expressions over the fields of the job's one split."""
    return {"l_orderkey": parse_long(field("fields", 0)), "l_linenumber": parse_int(field("fields", 3))}


def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    means, stds = _lineitem_moments(spark, sf_dir)
    data, _ = jobs.feature_frame(tables.lineitem_tab_lines(spark, sf_dir), STD_VARIABLES, TAB, moments=(means, stds), keep=_keys())
    return data.select("l_orderkey", "l_linenumber", *[_r(F.get("x", j)).alias(f"z{j}") for j in range(len(STD_VARIABLES))])


def _first_k_raw(spark: SparkSession, sf_dir: str, columns, k: int) -> list[list[float]]:
    table = read_table(spark, sf_dir, "lineitem").select(*dict.fromkeys([*tables.LINEITEM_ORDER, *columns]))
    rows = tables.first_rows(table, tables.LINEITEM_ORDER, k)
    return [[float(r[c]) for c in columns] for r in rows]


def _centers_df(spark: SparkSession, result: km.KMeansResult, dim: int) -> DataFrame:
    df = result.centers_frame(spark)
    return df.select(
        "cluster", *[_r(F.get(F.col("center"), j)).alias(f"x{j}") for j in range(dim)], F.col("n").cast("bigint")
    )


def _fit_raw(spark: SparkSession, sf_dir: str) -> km.KMeansResult:
    start = _first_k_raw(spark, sf_dir, ("l_quantity", "l_discount", "l_tax"), K)
    return jobs.kmeans_raw(
        tables.lineitem_whitespace_lines(spark, sf_dir), start, RAW_VARIABLES, max_iter=km.RAW_MAX_ITER, tol=km.TOLERANCE, delimiter=WHITESPACE
    )


def _fit_standardised(spark: SparkSession, sf_dir: str, variables=STD_VARIABLES, keep=None):
    """Standardised fit from the first K rows: one caching pass profiles the
    variables and feeds every iteration."""
    start = _first_k_raw(spark, sf_dir, ("l_quantity", "l_extendedprice", "l_discount"), K)
    return run_clustering(
        tables.lineitem_tab_lines(spark, sf_dir), k=K, max_iter=STD_MAX_ITER, variables=variables, init_centers_raw=start, width=LINEITEM_WIDTH, keep=keep
    )


def kmeans_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _centers_df(spark, _fit_raw(spark, sf_dir), len(RAW_VARIABLES))


def kmeans_standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on stored moments, as the command line runs it."""
    means, stds = _lineitem_moments(spark, sf_dir)
    start = _first_k_raw(spark, sf_dir, ("l_quantity", "l_extendedprice", "l_discount"), K)
    fit = jobs.kmeans_standardised(tables.lineitem_tab_lines(spark, sf_dir), start, STD_VARIABLES, means, stds, max_iter=STD_MAX_ITER)
    return _centers_df(spark, fit, len(STD_VARIABLES))


def kmeans_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trace of a fit that stopped after two rounds and went on from the rounds it had left."""
    means, stds = _lineitem_moments(spark, sf_dir)
    start = _first_k_raw(spark, sf_dir, ("l_quantity", "l_extendedprice", "l_discount"), K)
    state = scratch_path(spark, "rounds")
    for max_iter in (2, STD_MAX_ITER):
        fit = jobs.kmeans_standardised(tables.lineitem_tab_lines(spark, sf_dir), start, STD_VARIABLES, means, stds, max_iter=max_iter, state=state)
    return _trace(spark, fit)


def kmeans_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trace(spark, _fit_standardised(spark, sf_dir).fit)


def _trace(spark: SparkSession, fit: km.KMeansResult) -> DataFrame:
    return fit.trace_frame(spark).select(
        "iteration", _r(F.col("max_abs_shift")).alias("max_abs_shift"), _r(F.col("max_squared_shift")).alias("max_squared_shift"), "converged"
    )


def cluster_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_standardised(spark, sf_dir, keep=_keys()).assignments.select("l_orderkey", "l_linenumber", "cluster")


def clustering_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = run_clustering(
        tables.lineitem_tab_lines(spark, sf_dir, position=True), k=CLUSTER_K, max_iter=STD_MAX_ITER, variables=STD_VARIABLES, width=LINEITEM_WIDTH
    )
    return res.cluster_sizes()


def clustering_given_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = jobs.column_moments(tables.lineitem_tab_lines(spark, sf_dir), width=LINEITEM_WIDTH, columns=STD_VARIABLES)
    subset = jobs.subset_records(tables.lineitem_tab_lines(spark, sf_dir, position=True), bounds=SUBSET_BOUNDS, equals=SUBSET_EQUALS, member=SUBSET_MEMBER)
    res = run_clustering(
        subset, k=SUBSET_CLUSTER_K, max_iter=STD_MAX_ITER, variables=STD_VARIABLES, moments=full, width=LINEITEM_WIDTH
    )
    return res.cluster_sizes()


def kmeans_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    # the first K vectors are the start; their width is the vector width
    firsts = tables.first_rows(read_table(spark, sf_dir, "embeddings"), ["vec_id"], EMBED_K)
    start = [[float(x) for x in r["embedding"]] for r in firsts]
    feats = km.Features(array="embedding", width=len(start[0]))
    return _vector_sums(spark, km.fit(emb, feats, start, max_iter=km.RAW_MAX_ITER, tol=km.TOLERANCE, rule="max_abs"))


def _vector_sums(spark: SparkSession, result: km.KMeansResult) -> DataFrame:
    return result.centers_frame(spark).select(
        "cluster",
        F.col("n").cast("bigint"),
        _r(F.aggregate("center", F.lit(0.0), lambda a, x: a + x)).alias("center_sum"),
        _r(F.aggregate("center", F.lit(0.0), lambda a, x: a + x * x)).alias("center_sq"),
    )


# --------------------------------------------------------------------------- sampling and text I/O
def sample_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statforge.operators.order import sample_k as _sample

    o = read_table(spark, sf_dir, "orders", position=True)
    return _sample(o, SAMPLE_K).select("o_orderkey", "o_custkey", "o_totalprice")


def redelimit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank runs to tabs (S11), then ``cut -f1-5`` (P10): both the full
    re-delimited line and the cut one."""
    red = redelimit(tables.part_padded_lines(spark, sf_dir))
    return parse_delimited(red, "tab", keep_trailing_empty=True).select("value", cut_fields("fields", range(1, 6)).alias("cut"))


def header_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two headed text files of unequal size, one with a data row equal to the
    header, each joined from part files (K3), read back without their first lines (S10)."""
    path = scratch_path(spark, "headed")
    for name, lines in tables.headed_part_files(spark, sf_dir).items():
        write_lines(lines, f"{path}/{name}", merge=True, order_by="line_no")
    rows = parse_delimited(read_lines(spark, [f"{path}/small", f"{path}/large"], header="each"), "tab")
    return rows.select(
        parse_long(field("fields", 0)).alias("partkey"),
        field("fields", 1).alias("name"),
        parse_double(field("fields", 2)).alias("price"),
    )


def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value text output (K1) of supplier, read back (S1) and parsed."""
    supplier = read_table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "supplier-kv")
    write_lines(key_value_lines(supplier, "s_name", "s_acctbal"), path, mode="overwrite")
    back = parse_delimited(read_lines(spark, path), "tab")
    return back.select(field("fields", 0).alias("s_name"), parse_double(field("fields", 1)).alias("s_acctbal"))


def value_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value-only text output (K2): key, priority and status of every order as one value, read back."""
    orders = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "values")
    write_lines(single_column_lines(orders, F.concat_ws("/", "o_orderkey", "o_orderpriority", "o_orderstatus")), path)
    return read_lines(spark, path).select(F.col("value").alias("order_value"))


def merged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as lines sorted by key in one file joined from its parts (K3, O1), read
    back with every line's number in that file."""
    orders = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "merged")
    lines = orders.select("o_orderkey", F.concat_ws("\t", "o_orderkey", "o_orderstatus", "o_orderpriority").alias("value"))
    write_lines(lines, path, merge=True, order_by="o_orderkey")
    return read_lines(spark, path, position=True).select("line_no", "value")


def drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three jobs read, kept and dropped, by reason (F8) or as NaN."""
    found = []
    for job, run in {
        "year_range_projection": lambda c: jobs.year_range_projection(
            tables.orders_song_lines(spark, sf_dir), title=1, artist=2, duration=3, year=4, years=SONG_YEARS, counts=c
        ),
        "ngram_volume_stddev": lambda c: jobs.ngram_volume_stddev(tables.customer_unigram_lines(spark, sf_dir), tables.part_bigram_lines(spark, sf_dir), counts=c),
        "column_moments": lambda c: jobs.column_moments(tables.lineitem_tab_lines(spark, sf_dir), width=LINEITEM_WIDTH, counts=c),
    }.items():
        counts = DropCounts()
        run(counts).write.format("noop").mode("overwrite").save()
        found += [(job, source, what, n) for source, by in counts.get().items() for what, n in by.items()]
    return spark.createDataFrame(found, "job STRING, source STRING, what STRING, n BIGINT")


def wide_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of records of 128 fields (each vector and its squares), taken in the long form."""
    vectors = read_table(spark, sf_dir, "embeddings")
    both = F.concat("embedding", F.transform("embedding", lambda x: x * x))
    lines = vectors.select(F.array_join(F.transform(both, lambda x: x.cast("double").cast("string")), "\t").alias("value"))
    return jobs.column_moments(lines).select("col_idx", _r("mean").alias("mean"), _r("std").alias("std"))


def range_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range-partitioned maxima written as sorted part files, replacing an earlier
    output at the same path (K4), and read back with each line's part file number
    (O2: the bucket) and whether it follows its predecessor in key order (O1)."""
    path = scratch_path(spark, "range-parts")
    prices = tables.part_price_lines(spark, sf_dir)
    write_lines(key_value_lines(jobs.group_max_floor(prices, key=1, value=3), "key", "max_value"), path)
    maxima = jobs.range_partitioned_max(prices, key=2, value=3, break_points=BREAK_POINTS, parts_per_bucket=1)
    write_lines(key_value_lines(maxima, "key", "max_value"), path, mode="overwrite")
    part = F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1).cast("int").alias("bucket")
    back = parse_delimited(read_lines(spark, path).select("value", part, F.monotonically_increasing_id().alias("place")), "tab")
    rows = back.select("bucket", "place", field("fields", 0).alias("key"), parse_double(field("fields", 1)).alias("max_value"))
    before = F.lag("key").over(Window.partitionBy("bucket").orderBy("place"))
    return rows.select("key", "max_value", "bucket", F.coalesce(before < F.col("key"), F.lit(True)).alias("in_order"))


def moments_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments of columns 4, 5 and 6 only, written, read back and used by column position (K5)."""
    path = scratch_path(spark, "moments-some")
    lines = tables.lineitem_tab_lines(spark, sf_dir)
    write_moments(jobs.column_moments(lines, width=LINEITEM_WIDTH, columns=STD_VARIABLES), path)
    data, _ = jobs.feature_frame(lines, STD_VARIABLES, TAB, moments=moments_to_lists(read_moments(spark, path)), keep=_keys())
    return data.select("l_orderkey", "l_linenumber", *[_r(F.get("x", j)).alias(f"z{j}") for j in range(len(STD_VARIABLES))])


def kmeans_wide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw job on 64 blank-separated fields a line, rendered from the embeddings."""
    vectors = read_table(spark, sf_dir, "embeddings")
    firsts = tables.first_rows(vectors, ["vec_id"], EMBED_K)
    start = [[float(x) for x in r["embedding"]] for r in firsts]
    lines = vectors.select(F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), " ").alias("value"))
    return _vector_sums(spark, jobs.kmeans_raw(lines, start, range(len(start[0])), max_iter=km.RAW_MAX_ITER, tol=km.TOLERANCE))


def moments_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "moments")
    write_moments(jobs.column_moments(tables.lineitem_tab_lines(spark, sf_dir), width=LINEITEM_WIDTH), path)
    return _profile_long(read_moments(spark, path))


def centroid_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    vars_path = scratch_path(spark, "vars")
    write_lines(
        spark.range(1).select(F.lit(" ".join(str(v) for v in STD_VARIABLES) + " ").alias("value")),
        vars_path,
        mode="overwrite",
        merge=True,
    )
    variables = read_variables(spark, vars_path)
    result = _fit_standardised(spark, sf_dir, variables).fit
    path = scratch_path(spark, "centroids")
    write_centroids(centroids_frame(spark, result.centers), path)
    back = read_centroids(spark, path)
    return back.select("cluster", *[_r(F.get(F.col("center"), j)).alias(f"x{j}") for j in range(len(variables))])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_flag_mean": csv_flag_mean,
    "fixed_width_max": fixed_width_max,
    "year_range_project": year_range_project,
    "group_max_floor": group_max_floor,
    "range_bucket_max": range_bucket_max,
    "substring_mean": substring_mean,
    "union_stddev": union_stddev,
    "column_profile": column_profile,
    "row_subset": row_subset,
    "standardise": standardise,
    "kmeans_raw": kmeans_raw,
    "kmeans_standardised": kmeans_standardised,
    "kmeans_trace": kmeans_trace,
    "kmeans_resumed": kmeans_resumed,
    "cluster_assign": cluster_assign,
    "clustering_end_to_end": clustering_end_to_end,
    "clustering_given_moments": clustering_given_moments,
    "kmeans_embeddings": kmeans_embeddings,
    "sample_k": sample_k,
    "redelimit": redelimit_query,
    "header_skip": header_skip,
    "text_roundtrip": text_roundtrip,
    "value_lines": value_lines,
    "merged_lines": merged_lines,
    "drop_counts": drop_counts,
    "wide_profile": wide_profile,
    "range_parts": range_parts,
    "moments_positions": moments_positions,
    "kmeans_wide_text": kmeans_wide_text,
    "moments_file": moments_file,
    "centroid_file": centroid_file,
}
