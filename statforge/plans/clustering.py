"""End-to-end clustering: profile -> variables -> sample k -> fit -> assign.

One function replaces the driver script of shell and HDFS steps. The text is
scanned twice in total:

1. one pass parses every line once into a compact cached frame holding, per
   line, the chosen raw features and, if the start is drawn, a sample key (16 bytes, from
   its position); it is freed once the fit has a frame of its own. The
   profile of those columns (one global aggregate, unless moments are
   supplied), the k-row sample (a per-task top-k) and every k-means
   iteration then run against that cache;
2. one map-only pass labels every original line.

What reaches the driver is bounded by the parameters: the moments of the
chosen columns, the k sampled rows and k x d centroids per iteration.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.functions.parse import TAB
from statforge.operators import kmeans as km
from statforge.operators import project as proj
from statforge.plans import jobs
from statforge.sources.params import moments_to_lists
from statforge.sources.position import has_position, placed_rank, rank
from statforge.sources.text import parse_delimited

# The variables the driver script clusters on (1-based columns).
DEFAULT_VARIABLES_1BASED = (21, 24, 26)


@dataclass
class ClusteringResult:
    moments: DataFrame
    means: list[float]
    stds: list[float]
    variables: list[int]
    init_centers_raw: list[list[float]]
    fit: km.KMeansResult
    assignments: DataFrame

    def cluster_sizes(self) -> DataFrame:
        """``DataFrame[cluster, n]`` over the assignment (one aggregation)."""
        return self.assignments.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


def run_clustering(
    lines: DataFrame,
    k: int,
    max_iter: int,
    variables: Sequence[int] | None = None,
    moments: DataFrame | None = None,
    seed: int = 0,
    tol: float = km.TOLERANCE,
    init_centers_raw: Sequence[Sequence[float]] | None = None,
    delimiter: str = TAB,
    profile_all: bool = False,
    cache: str = "persist",
    width: int | None = None,
    keep: Mapping[str, Column] | None = None,
    state: str | None = None,
) -> ClusteringResult:
    """Run the whole clustering on delimited records (tab by default).

    ``variables`` are 0-based column indices (default: the script's fixed
    three). ``moments`` reuses a stored profile (for example of a larger table
    than ``lines``, I9); otherwise the chosen columns are profiled in the
    caching pass (``profile_all=True`` profiles every column in an extra pass,
    for the full moments file). The k starting rows are drawn by the rank of
    their position, as in ``sample_k`` (``seed`` salts it), unless ``init_centers_raw`` gives them.
    A file's header is left out when it is read (``read_lines(header=...)``).
    With ``width`` given, a record wider than that fails the profile, as in the
    full profile job; without it no probe of the first record is made (the
    chosen columns need none). ``keep`` names expressions over ``value`` and
    ``fields`` that the assignments carry instead of the line. ``state`` names a
    folder from which the fit goes on if an earlier run left whole rounds there.
    """
    spark = lines.sparkSession
    chosen = list(variables) if variables is not None else [v - 1 for v in DEFAULT_VARIABLES_1BASED]
    if profile_all and moments is None:
        moments = jobs.column_moments(lines, delimiter=delimiter)

    rows = parse_delimited(lines, delimiter)
    d = len(chosen)
    names = [f"x{j}" for j in range(d)]
    values = proj.feature_columns("fields", chosen, on_bad="fail")
    if width is not None and values:
        too_wide = F.raise_error(F.lit(f"record wider than {width} fields")).cast("double")
        values[0] = F.when(F.size("fields") <= width, values[0]).otherwise(too_wide)
    cols = [v.alias(n) for v, n in zip(values, names)]
    if init_centers_raw is None:
        key = rank(seed) if has_position(rows) else placed_rank(F.monotonically_increasing_id(), seed)
        cols.append(key.alias("_h"))
    profiled = moments is None
    # d doubles (and the key's 16 bytes) per line. The profile value of a chosen column is
    # the feature itself, or 0 for a missing trailing field (an unparsable one
    # fails the pass either way), so it is derived from the cache, not stored.
    cached = rows.select(*cols)
    if cache == "checkpoint":
        from statforge.session import checkpoint_dir

        checkpoint_dir(spark)
        cached = cached.checkpoint(eager=True)
    else:
        cached = cached.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if profiled:
            aggs = [F.count(F.lit(1)).alias("_n")]
            for j in range(d):
                p = F.coalesce(F.col(names[j]), F.lit(0.0))
                aggs += [F.avg(p).alias(f"m{j}"), F.stddev_pop(p).alias(f"s{j}")]
            stats = cached.agg(*aggs).first()
            if not stats or stats["_n"] == 0:
                raise ValueError("no records to cluster")
            data = [(i, float(stats[f"m{j}"]), float(stats[f"s{j}"])) for j, i in enumerate(chosen)]
            moments = spark.createDataFrame(data, "col_idx INT, mean DOUBLE, std DOUBLE")
            width_all = max(chosen) + 1
            means = [float("nan")] * width_all
            stds = [float("nan")] * width_all
            for i, m, s in data:
                means[i], stds[i] = m, s
        else:
            means, stds = moments_to_lists(moments)
        proj.check_moments(chosen, means, stds)

        if init_centers_raw is not None:
            start = [[float(x) for x in c] for c in init_centers_raw]
        else:
            picked = cached.orderBy("_h", *names).limit(k).select(*names).collect()
            start = []
            for r in picked:
                if any(v is None for v in r):
                    raise ValueError("sampled row lacks a chosen variable")
                start.append([float(v) for v in r])

        z = proj.standardise([F.col(n) for n in names], chosen, means, stds)
        points = cached.select(F.array(*z).alias("x"))
        std_start = proj.standardise_centers(start, chosen, means, stds)
        result = km.fit(
            points, km.Features(array="x", width=d), std_start, max_iter=max_iter, tol=tol, rule="squared_shift", cache=cache, state=state,
            free_points=None if cache == "checkpoint" else cached.unpersist,
        )
    finally:
        if cache != "checkpoint":
            cached.unpersist()
    assigned = jobs.assign_clusters(lines, result.centers, chosen, moments=(means, stds), delimiter=delimiter, keep=keep)
    return ClusteringResult(moments, means, stds, chosen, start, result, assigned)
