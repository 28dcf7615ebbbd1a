"""Command line: each job over text paths, writing the original output formats.

    spark-submit statforge/cli.py <job> <args...> [--overwrite]
    python -m statforge.cli <job> <args...> [--master local[8]]

Jobs and arguments (paths are files or directories of text):

    flag-mean      IN OUT                                 key<TAB>mean
    station-max    IN OUT                                 year<TAB>max
    year-project   IN OUT                                 artist<TAB>duration<TAB>title<TAB>year
    range-max      IN OUT                                 key<TAB>max, buckets in ordered part files
    substring-mean UNIGRAMS BIGRAMS OUT                   "year | substring"<TAB>mean
    volume-stddev  UNIGRAMS BIGRAMS OUT                   one value
    moments        IN OUT                                 means line, std devs line
    subset         IN OUT                                 the kept lines
    kmeans-raw     IN CENTROIDS VARS OUT                  final centroids (raw scale)
    kmeans         IN CENTROIDS VARS MOMENTS MAXITER OUT  final centroids (standardised)
    assign         IN CENTROIDS VARS MOMENTS OUT          cluster<TAB>line
    cluster        DATA K MAXITER MOMENTS OUT             moments file, OUT/centroids, OUT/assigned
    sample         IN K VARS OUT                          k sampled rows, the chosen columns, as a centroid file
    redelimit      IN OUT                                 blank runs to tabs
    cut            IN LIST OUT                            the listed 1-based tab fields

``--header`` leaves out the first line of every input file. ``cluster`` takes its
columns from ``--vars`` (1-based, comma-separated; three fixed ones by default), and
with ``--given-moments`` reads the file MOMENTS (of a larger table, say) instead of
profiling the data and writing it. Outputs replace an existing path only with ``--overwrite``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from statforge import sinks
from statforge.operators.counted import DropCounts
from statforge.operators.order import DEFAULT_PARTS_PER_BUCKET, sample_k
from statforge.operators.project import feature_columns
from statforge.plans import jobs
from statforge.plans.clustering import run_clustering
from statforge.session import get_session
from statforge.sources import (
    centroids_frame,
    centroids_to_list,
    cut_fields,
    moments_to_lists,
    parse_delimited,
    read_centroids,
    read_lines,
    read_moments,
    read_variables,
    redelimit,
)


def _out(df, path, mode, merge=False):
    sinks.write_lines(df, path, mode=mode, merge=merge)


def _kv(df, key, value):
    return sinks.key_value_lines(df, key, value)


def _said(counts: DropCounts) -> str:
    """One line for each source: what was read, kept, and dropped for which reason."""
    return "\n".join(f"{source}: " + ", ".join(f"{n} {what}" for what, n in by.items()) for source, by in counts.get().items())


def run(args: argparse.Namespace, spark: SparkSession) -> str | None:
    mode = "overwrite" if args.overwrite else "errorifexists"
    job, a = args.job, args.args
    need = {
        "flag-mean": 2, "station-max": 2, "year-project": 2, "range-max": 2, "substring-mean": 3, "volume-stddev": 3,
        "moments": 2, "subset": 2, "kmeans-raw": 4, "kmeans": 6, "assign": 5, "cluster": 5, "sample": 4, "redelimit": 2, "cut": 3,
    }
    if job not in need:
        raise SystemExit(f"unknown job {job!r}")
    if len(a) != need[job]:
        raise SystemExit(f"{job} takes {need[job]} arguments, got {len(a)}")
    header = "each" if args.header else None
    lines = read_lines(spark, a[0], header=header, position=job in ("sample", "cluster"))  # samples are drawn by position
    counts = DropCounts()
    if job == "flag-mean":
        _out(_kv(jobs.flag_group_mean(lines, counts=counts), "group_key", "mean_value"), a[1], mode)
        return _said(counts)
    if job == "station-max":
        _out(_kv(jobs.station_year_max(lines), "year", "max_value"), a[1], mode)
    elif job == "year-project":
        _out(jobs.projection_lines(jobs.year_range_projection(lines, counts=counts)), a[1], mode)
        return _said(counts)
    elif job == "range-max":
        maxima = jobs.range_partitioned_max(lines, parts_per_bucket=args.parts_per_bucket, counts=counts)
        _out(maxima.select(F.concat_ws("\t", "key", F.col("max_value").cast("string")).alias("value")), a[1], mode)
        return _said(counts)
    elif job == "substring-mean":
        _out(_kv(jobs.ngram_substring_mean(lines, read_lines(spark, a[1], header=header), counts=counts), "tag_key", "mean_volumes"), a[2], mode)
        return _said(counts)
    elif job == "volume-stddev":
        out = jobs.ngram_volume_stddev(lines, read_lines(spark, a[1], header=header), counts=counts)
        _out(sinks.single_column_lines(out, "stddev"), a[2], mode, merge=True)
        return _said(counts)
    elif job == "moments":
        sinks.write_moments(jobs.column_moments(lines), a[1], mode=mode)
    elif job == "subset":
        _out(jobs.subset_rows(lines), a[1], mode)
    elif job == "kmeans-raw":
        start = centroids_to_list(read_centroids(spark, a[1]))
        result = jobs.kmeans_raw(lines, start, read_variables(spark, a[2]), state=args.state)
        sinks.write_centroids(centroids_frame(spark, result.centers), a[3], mode=mode)
        return result.report()
    elif job == "kmeans":
        start = centroids_to_list(read_centroids(spark, a[1]))
        means, stds = moments_to_lists(read_moments(spark, a[3]))
        result = jobs.kmeans_standardised(lines, start, read_variables(spark, a[2]), means, stds, max_iter=int(a[4]), state=args.state)
        sinks.write_centroids(centroids_frame(spark, result.centers), a[5], mode=mode)
        return result.report()
    elif job == "assign":
        centers = centroids_to_list(read_centroids(spark, a[1]))
        moments = moments_to_lists(read_moments(spark, a[3]))
        assigned = jobs.assign_clusters(lines, centers, read_variables(spark, a[2]), moments=moments)
        _out(jobs.assignment_lines(assigned), a[4], mode)
    elif job == "cluster":
        given = read_moments(spark, a[3]) if args.given_moments else None
        variables = [int(v) - 1 for v in args.vars.split(",")] if args.vars else None
        res = run_clustering(lines, k=int(a[1]), max_iter=int(a[2]), variables=variables, moments=given, profile_all=given is None, seed=args.seed, state=args.state)
        if given is None:
            sinks.write_moments(res.moments, a[3], mode=mode)
        sinks.write_centroids(centroids_frame(spark, res.fit.centers), f"{a[4]}/centroids", mode=mode)
        _out(jobs.assignment_lines(res.assignments), f"{a[4]}/assigned", mode)
        return res.fit.report()
    elif job == "sample":
        rows = parse_delimited(sample_k(lines, int(a[1]), seed=args.seed), "tab")
        picked = rows.select(F.array(*feature_columns("fields", read_variables(spark, a[2]))).alias("center"))
        start = [[float(x) for x in r["center"]] for r in picked.collect()]  # k rows
        sinks.write_centroids(centroids_frame(spark, start), a[3], mode=mode)
    elif job == "redelimit":
        _out(redelimit(lines), a[1], mode)
    elif job == "cut":
        wanted = [int(i) for i in a[1].split(",")]
        _out(parse_delimited(lines, "tab", keep_trailing_empty=True).select(cut_fields("fields", wanted).alias("value")), a[2], mode)
    return None


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="statforge", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job")
    p.add_argument("args", nargs="*")
    p.add_argument("--overwrite", action="store_true", help="replace existing outputs")
    p.add_argument(
        "--parts-per-bucket",
        type=int,
        default=DEFAULT_PARTS_PER_BUCKET,
        help=f"range-max: ordered part files per range bucket (1 = one file per bucket; default {DEFAULT_PARTS_PER_BUCKET})",
    )
    p.add_argument("--header", action="store_true", help="leave out the first line of every input file")
    p.add_argument("--vars", default=None, help="cluster: 1-based columns, comma-separated")
    p.add_argument("--given-moments", action="store_true", help="cluster: read MOMENTS instead of profiling the data")
    p.add_argument("--seed", type=int, default=0, help="sample, cluster: another sample")
    p.add_argument("--state", default=None, help="kmeans, kmeans-raw, cluster: folder for the finished rounds, from which a stopped fit goes on")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    session = spark or get_session(args.master)
    report = run(args, session)
    if report:
        print(report)
    return 0


if __name__ == "__main__":
    sys.exit(main())
