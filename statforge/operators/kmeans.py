"""k-means as Spark jobs.

One iteration is one Spark job over the kept feature frame:

* nearest centroid per row, centroids inlined as literals (map-side, J1);
* ``groupBy(cluster)`` of (count, mean per feature): partial aggregation in
  every task, then an exchange of at most k small rows per task (A7, A8);
* the k new centroids (k x d doubles) come back to the driver, where the
  convergence test runs (I3 / I4).

Nothing but those k rows reaches the driver, the data is scanned once per
iteration, and the plan has a single tiny shuffle whatever the data size.
A cluster holding a third of all rows is just one partial buffer per task.

Most distances are never computed. The kept frame carries, beside each vector, its
cluster, its distance to that centroid and its distance to the next best one, all
measured from the *anchor*: the centroids of the round in which the frame was written.
A centroid that has moved by ``m`` since then is at most ``m`` nearer or farther, so a row
whose own centroid is, by these bounds, still nearer than any other needs no distance;
a row that its exact distance settles needs one; only the others need all k. When such
rows become many the frame is written anew, with the current centroids as anchor. The
bounds have a margin for rounding, so clusters, centroids, sizes and iterations are those
of the plain method.

A few short centroids (``UNROLLED``) are worked on as one double column a coordinate: the
kept frame then has primitive columns alone and a round is compiled as a whole.
"""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.files import path_exists
from statforge.functions.vectors import (
    distance,
    distance_columns,
    distances_columns,
    first_least_columns,
    least_of,
    nearest_centroid_array,
    two_nearest,
)
from statforge.sources.text import with_columns_once

# Iteration cap of the raw-scale job, and the tolerance both
# convergence tests use.
RAW_MAX_ITER = 10
TOLERANCE = 0.01


@dataclass
class Features:
    """Where the feature vector of a row lives.

    Either ``columns`` (one double column per feature) or ``array`` (one
    ``array<double>`` column of width ``width``). Both are worked on as one array.
    """

    columns: tuple[str, ...] = ()
    array: str | None = None
    width: int | None = None

    @property
    def dim(self) -> int:
        return len(self.columns) if self.array is None else int(self.width or 0)

    def vector(self) -> Column:
        if self.array is None:
            return F.array(*[F.col(c).cast("double") for c in self.columns])
        return F.col(self.array).cast("array<double>")

    def complete(self) -> Column:
        """Vector of the right length without missing values (NaN allowed), as the assignment needs."""
        v = self.vector()
        return F.coalesce((F.size(v) == F.lit(self.dim)) & ~F.exists(v, lambda x: x.isNull()), F.lit(False))

    def valid(self) -> Column:
        """Complete and finite vector (rows failing this are left out of a fit, and counted)."""
        unusable = lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
        return self.complete() & ~F.exists(self.vector(), unusable)

    def nearest(self, centers: Sequence[Sequence[float]]) -> Column:
        return nearest_centroid_array(self.vector(), centers)

    def bounded(self, centers: Sequence[Sequence[float]]) -> Column:
        """``struct(cluster, upper, lower)``: nearest centroid, its distance, and that of the next one."""
        return two_nearest(self.vector(), centers)


def max_abs_shift(old: Sequence[Sequence[float]], new: Sequence[Sequence[float]]) -> float:
    """Largest coordinate move over all centroids (the raw job's test, I3)."""
    return max((abs(a - b) for o, n in zip(old, new) for a, b in zip(o, n)), default=0.0)


def squared_shifts(old: Sequence[Sequence[float]], new: Sequence[Sequence[float]]) -> list[float]:
    """Per-centroid squared movement (the standardised job's test, I4)."""
    return [sum((a - b) * (a - b) for a, b in zip(o, n)) for o, n in zip(old, new)]


def has_converged(old, new, rule: str, tol: float) -> bool:
    if rule == "max_abs":
        return max_abs_shift(old, new) <= tol
    if rule == "squared_shift":
        return all(s <= tol for s in squared_shifts(old, new))
    raise ValueError(f"unknown convergence rule {rule!r}")


@dataclass
class KMeansResult:
    centers: list[list[float]]
    sizes: list[int]
    iterations: int
    converged: bool
    trace: list[dict] = field(default_factory=list)
    left_out: int = 0  # rows with a missing, NaN or infinite feature

    @property
    def distances(self) -> int:
        """Distances computed in all rounds (the plain method takes rows x clusters in each)."""
        return sum(t["distances"] for t in self.trace)

    def report(self) -> str:
        """Convergence report (I5), and how many rows the fit could not use."""
        state = f"converged after iteration {self.iterations}" if self.converged else f"still moving after iteration {self.iterations}"
        return f"{state}; {self.left_out} rows left out"

    def centers_frame(self, spark: SparkSession) -> DataFrame:
        data = [(i, [float(x) for x in c], int(n)) for i, (c, n) in enumerate(zip(self.centers, self.sizes))]
        return spark.createDataFrame(data, "cluster INT, center ARRAY<DOUBLE>, n BIGINT")

    def trace_frame(self, spark: SparkSession) -> DataFrame:
        data = [
            (t["iteration"], float(t["max_abs_shift"]), float(t["max_squared_shift"]), bool(t["converged"]))
            for t in self.trace
        ]
        return spark.createDataFrame(
            data, "iteration INT, max_abs_shift DOUBLE, max_squared_shift DOUBLE, converged BOOLEAN"
        )


#: Above this width the coordinates of a cluster are summed as one vector, not column by column.
WIDE = 256
#: Up to so many values of all centroids, distances are written out column by column (more would be too large to compile).
UNROLLED = 64


def _unrolled(k: int, dim: int) -> bool:
    return 0 < k * dim <= UNROLLED


def _cluster_means(assigned: DataFrame, dim: int) -> DataFrame:
    """``cluster, n, distances, center`` of rows ``cluster, cost, x`` or ``cluster, cost, x0, x1, ...``.

    Narrow vectors take one ``avg`` a coordinate (a hash aggregate); wide ones a
    vector-valued sum, of which a task has one for each cluster, merged by element.
    """
    counted = [F.count(F.lit(1)).alias("n"), F.sum("cost").alias("distances")]
    if dim <= WIDE:
        # one parsed SQL expression per element keeps building the plan cheap
        value = "get(x, {})" if "x" in assigned.columns else "x{}"
        means = [F.expr(f"avg({value.format(j)}) AS c{j}") for j in range(dim)]
        rows = assigned.groupBy("cluster").agg(*counted, *means)
        return rows.select("cluster", "n", "distances", F.array(*[f"c{j}" for j in range(dim)]).alias("center"))
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    zeros = F.array_repeat(F.lit(0.0), dim)
    usable = F.when(F.col("cluster") >= 0, F.col("x")).otherwise(zeros)  # rows left out are only counted
    rows = assigned.withColumn("v", array_to_vector(usable)).groupBy("cluster").agg(*counted, Summarizer.sum(F.col("v")).alias("total"))
    return rows.select("cluster", "n", "distances", F.transform(vector_to_array("total"), lambda t: t / F.col("n")).alias("center"))


def _update(assigned: DataFrame, centers: Sequence[Sequence[float]], dim: int) -> tuple[list[list[float]], list[int], int, int]:
    """New centroids, their sizes, rows left out, and distances computed. Empty clusters keep their centroid."""
    new = [list(c) for c in centers]
    sizes = [0] * len(centers)
    left_out = distances = 0
    for r in _cluster_means(assigned, dim).collect():
        i = int(r["cluster"])
        distances += int(r["distances"])
        if i < 0:
            left_out = int(r["n"])
            continue
        sizes[i] = int(r["n"])
        new[i] = [float(v) for v in r["center"]]
    return new, sizes, left_out, distances


def lloyd_step(data: DataFrame, features: Features, centers: Sequence[Sequence[float]]) -> tuple[list[list[float]], list[int], int]:
    """One assignment + update pass without bounds: new centroids, their sizes, rows left out.

    Empty clusters keep their old centroid. Unusable rows are counted in the same
    pass, as a group of their own.
    """
    cluster = F.when(features.valid(), features.nearest(centers)).otherwise(F.lit(-1))
    rows = data.select(cluster.alias("cluster"), F.lit(len(centers)).alias("cost"), features.vector().alias("x"))
    return _update(rows, centers, features.dim)[:3]


class BoundedRounds:
    """Rounds over a frame that carries each row's bounds (see the module's text).

    ``keep`` writes or persists a frame and gives it back with a function that frees it.
    """

    #: The frame is written anew when a round computed more than this share of all distances.
    RENEW = 0.25

    def __init__(self, points: DataFrame, features: Features, keep, k: int, free_points=None):
        own = Features(array="x", width=features.dim)
        # the vector is built once a row, however often the expressions below refer to it
        vectors = with_columns_once(points.select(features.vector().alias("x")), {"x": F.col("x")})
        self.dim, self.keep = features.dim, keep
        #: The coordinates' columns, if distances are written out.
        self.columns = [f"x{j}" for j in range(features.dim)] if _unrolled(k, features.dim) else []
        if self.columns:
            value = [F.get("x", j) for j in range(self.dim)]
            usable = F.size("x") == F.lit(self.dim)
            for v in value:
                usable = usable & (F.abs(v) < F.lit(float("inf")))  # not for NaN, the greatest
            usable = F.coalesce(usable, F.lit(False))
            # no nulls in any column: a row that cannot be used has zeros, and cluster -1 throughout
            given = vectors.select(usable.alias("usable"), *[v.alias(c) for c, v in zip(self.columns, value)])
            self.vectors = given.select("usable", *[F.coalesce(F.when(F.col("usable"), F.col(c)), F.lit(0.0)).alias(c) for c in self.columns])
        else:
            self.vectors = vectors.select(F.when(own.valid(), F.col("x")).alias("x"))
        self.frame: DataFrame | None = None
        self.anchor: list[list[float]] = []
        #: Frees what the next frame is written from: at first the points, if they are kept for the fit alone.
        self.free = free_points or (lambda: None)
        self.stale = True

    def _renewed(self, centers: list[list[float]]) -> DataFrame:
        """Vectors, cluster and bounds. A row that cannot be used has cluster -1 and no vector."""
        if self.columns:
            usable = F.col("usable") if self.frame is None else F.col("cluster") >= 0
            source = self.vectors if self.frame is None else self.frame
            named = [f"d{i}" for i in range(len(centers))]
            dists = distances_columns([F.col(c) for c in self.columns], centers)
            # each step refers to columns of the step before, so that nothing is computed twice
            rows = source.select(*self.columns, usable.alias("usable"), *[d.alias(n) for d, n in zip(dists, named)])
            cols = [F.col(n) for n in named]
            rows = rows.select("*", first_least_columns(cols).alias("best"))
            infinite = F.lit(float("inf"))
            others = least_of([F.when(F.col("best") == i, infinite).otherwise(d) for i, d in enumerate(cols)])
            return rows.select(*self.columns, F.when(F.col("usable"), F.col("best")).otherwise(F.lit(-1)).alias("cluster"), least_of(cols).alias("upper"), others.alias("lower"))
        source = self.vectors if self.frame is None else self.frame.select("x")
        own = Features(array="x", width=self.dim)
        rows = source.select("x", F.when(F.col("x").isNotNull(), own.bounded(centers)).alias("b"))
        return rows.select("x", F.coalesce("b.cluster", F.lit(-1)).alias("cluster"), F.col("b.upper").alias("upper"), F.col("b.lower").alias("lower"))

    def _renew(self, centers: list[list[float]]) -> None:
        """Write the frame with ``centers`` as anchor."""
        frame, free = self.keep(self._renewed(centers))
        self.frame, self.anchor, self.stale = frame, [list(c) for c in centers], False
        self._free_before, self.free = self.free, free

    def _assigned(self, centers: list[list[float]]) -> DataFrame:
        """``cluster, cost`` and the vector: the cluster of every row and the number of distances that it took."""
        own, k = Features(array="x", width=self.dim), len(centers)
        moved = [math.dist(a, c) for a, c in zip(self.anchor, centers)]
        others = [max((m for j, m in enumerate(moved) if j != i), default=0.0) for i in range(k)]
        slack = 4e-15 * (self.dim + 8)  # well above the relative error of a distance
        cluster = F.col("cluster")
        pick = lambda values: F.get(F.lit([float(v) for v in values]), cluster)
        upper, lower = F.col("upper") + pick(moved), F.col("lower") - pick(others)
        margin = F.lit(slack) * (F.col("upper") + F.col("lower") + F.lit(4 * max(moved)))
        sure = (lower < F.lit(float("inf"))) & (upper + margin < lower)
        if self.columns:
            values = [F.col(c) for c in self.columns]
            exact = distance_columns(values, [pick([c[j] for c in centers]) for j in range(self.dim)])
        else:
            exact = distance(F.col("x"), F.get(F.lit([[float(v) for v in c] for c in centers]), cluster))
        settled = (lower < F.lit(float("inf"))) & (exact + margin < lower)
        if self.columns:
            # one number says cluster and cost (below k: none, below 2k: one, others: k + 1), and is computed once a row
            best = first_least_columns(distances_columns(values, centers))
            code = F.when((cluster < 0) | sure | F.lit(k == 1), cluster).when(settled, cluster + F.lit(k)).otherwise(best + F.lit(2 * k))
            coded = self.frame.select(code.alias("code"), *self.columns)
            cost = F.when(F.col("code") < k, F.lit(0)).when(F.col("code") < 2 * k, F.lit(1)).otherwise(F.lit(k + 1))
            return coded.select(F.when(F.col("code") < 0, F.lit(-1)).otherwise(F.col("code") % k).alias("cluster"), cost.alias("cost"), *self.columns)
        done = lambda c, cost: F.struct(c.cast("int").alias("cluster"), F.lit(cost).alias("cost"))
        found = F.when((cluster < 0) | sure | F.lit(k == 1), done(cluster, 0)).when(settled, done(cluster, 1)).otherwise(done(own.nearest(centers), k + 1))
        return self.frame.select(found.alias("f"), "x").select("f.cluster", "f.cost", "x")

    def step(self, centers: list[list[float]]) -> tuple[list[list[float]], list[int], int, int]:
        """One round: new centroids, sizes, rows left out, distances computed."""
        renewed = self.stale
        if renewed:
            self._renew(centers)
        new, sizes, left_out, distances = _update(self._assigned(centers), centers, self.dim)
        every = len(centers) * sum(sizes)
        if renewed:
            self._free_before()
            distances += every
        else:
            self.stale = distances > self.RENEW * every
        return new, sizes, left_out, distances


def _kept(cache: str):
    """How a frame is kept: a function from a frame to it and to what frees it."""

    def persisted(frame: DataFrame):
        frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
        return frame, frame.unpersist

    def written(frame: DataFrame):
        from statforge.session import checkpoint_dir

        checkpoint_dir(frame.sparkSession)
        return frame.checkpoint(eager=True), lambda: None

    if cache not in ("persist", "checkpoint"):
        raise ValueError(f"cache must be 'persist' or 'checkpoint', not {cache!r}")
    return persisted if cache == "persist" else written


def fit(
    points: DataFrame,
    features: Features,
    init_centers: Sequence[Sequence[float]],
    max_iter: int = RAW_MAX_ITER,
    tol: float = TOLERANCE,
    rule: str = "max_abs",
    cache: str = "persist",
    state: str | None = None,
    free_points=None,
) -> KMeansResult:
    """Lloyd iterations from given starting centroids (I1, I2 once standardised).

    Stops when the convergence test passes or after ``max_iter`` iterations.
    Rows with a missing, NaN or infinite feature are left out of the fit; the
    result says how many.

    The parsed feature frame with its bounds is kept for the iterations. ``cache="persist"``
    keeps it in executor memory, spilling to disk; a lost executor only
    recomputes its own blocks from their input splits. ``cache="checkpoint"``
    writes it to the shared checkpoint folder (``spark.checkpoint.dir``)
    and cuts the lineage, so a lost executor never re-reads the raw input.

    ``state`` names a folder in which every finished round leaves its centroids. A fit
    that finds whole rounds of the same start, rule and tolerance there goes on after
    the last of them, with the trace of all; so a fit survives the loss of its driver, and
    a larger ``max_iter`` carries on where a smaller one stopped. See ``RoundState``.

    ``free_points`` frees ``points`` if these are kept for the fit alone; it is called as
    soon as the fit has a frame of its own.
    """
    centers = [[float(x) for x in c] for c in init_centers]
    if not centers:
        raise ValueError("need at least one starting centroid")
    for c in centers:
        if len(c) != features.dim:
            raise ValueError(f"starting centroid has {len(c)} values, expected {features.dim}")
        if not all(math.isfinite(x) for x in c):
            raise ValueError("NaN or infinity in a starting centroid")

    rounds = BoundedRounds(points, features, _kept(cache), len(centers), free_points)
    stored = RoundState(points.sparkSession, state, centers, rule, tol) if state else None
    result = KMeansResult(centers=centers, sizes=[0] * len(centers), iterations=0, converged=False)
    if stored:
        stored.load(result, max_iter)
    try:
        while not result.converged and result.iterations < max_iter:
            started = time.perf_counter()
            new, sizes, left_out, distances = rounds.step(result.centers)
            seconds = time.perf_counter() - started
            sq = squared_shifts(result.centers, new)
            result.converged = has_converged(result.centers, new, rule, tol)
            result.iterations += 1
            result.trace.append(
                {
                    "iteration": result.iterations,
                    "max_abs_shift": max_abs_shift(result.centers, new),
                    "max_squared_shift": max(sq, default=0.0),
                    "squared_shifts": sq,
                    "sizes": list(sizes),
                    "converged": result.converged,
                    "seconds": seconds,
                    "distances": distances,
                }
            )
            result.centers, result.sizes, result.left_out = new, sizes, left_out
            if stored:
                stored.save(result)
    finally:
        rounds.free()
    return result


class RoundState:
    """The finished rounds of a fit, one small parquet folder each (``round-000001``, ...), a row a cluster.

    A round is whole if it has all its rows; what a lost driver left half written is
    passed over and written again. The folder belongs to one fit of one input: rounds of
    another start, rule or tolerance are refused.
    """

    SCHEMA = (
        "fit STRING, iteration INT, cluster INT, center ARRAY<DOUBLE>, n BIGINT, squared_shift DOUBLE, max_abs_shift DOUBLE, "
        "converged BOOLEAN, left_out BIGINT, seconds DOUBLE, distances BIGINT"
    )

    def __init__(self, spark: SparkSession, path: str, start: list[list[float]], rule: str, tol: float):
        self.spark, self.path, self.k = spark, path.rstrip("/"), len(start)
        self.fit = hashlib.sha256(json.dumps([start, rule, tol]).encode()).hexdigest()

    def _round(self, i: int) -> str:
        return f"{self.path}/round-{i:06d}"

    def _read(self, i: int) -> list:
        if not path_exists(self.spark, self._round(i)):
            return []
        rows = self.spark.read.schema(self.SCHEMA).parquet(self._round(i)).orderBy("cluster").collect()  # k rows
        if any(r["fit"] != self.fit for r in rows):
            raise ValueError(f"{self.path} holds the rounds of another fit")
        return rows if [r["cluster"] for r in rows] == list(range(self.k)) else []

    def load(self, result: KMeansResult, max_iter: int) -> None:
        """Put the whole rounds, from the first on and ``max_iter`` at most, into ``result``."""
        while result.iterations < max_iter and not result.converged:
            rows = self._read(result.iterations + 1)
            if not rows:
                return
            first, sq = rows[0], [r["squared_shift"] for r in rows]
            result.centers, result.sizes = [list(r["center"]) for r in rows], [r["n"] for r in rows]
            result.iterations, result.converged, result.left_out = first["iteration"], first["converged"], first["left_out"]
            result.trace.append(
                {
                    "iteration": first["iteration"],
                    "max_abs_shift": first["max_abs_shift"],
                    "max_squared_shift": max(sq, default=0.0),
                    "squared_shifts": sq,
                    "sizes": list(result.sizes),
                    "converged": first["converged"],
                    "seconds": first["seconds"],
                    "distances": first["distances"],
                }
            )

    def save(self, result: KMeansResult) -> None:
        t = result.trace[-1]
        rows = [
            (self.fit, t["iteration"], i, c, n, t["squared_shifts"][i], t["max_abs_shift"], t["converged"], result.left_out, t["seconds"], t["distances"])
            for i, (c, n) in enumerate(zip(result.centers, result.sizes))
        ]
        self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("overwrite").parquet(self._round(t["iteration"]))


def assign(
    points: DataFrame,
    features: Features,
    centers: Sequence[Sequence[float]],
    out: str = "cluster",
) -> DataFrame:
    """Label every row with its nearest centroid (I6, O4). Map-only, no shuffle.

    A row whose vector is incomplete gets cluster -1; an all-NaN vector gets 0.
    """
    if _unrolled(len(centers), features.dim):
        # each step refers to columns of the step before, so that nothing is computed twice
        given = with_columns_once(points, {"__vector": features.vector()})
        values = [F.get("__vector", j) for j in range(features.dim)]
        complete = F.size("__vector") == F.lit(features.dim)
        for v in values:
            complete = complete & v.isNotNull()
        named = [f"__d{i}" for i in range(len(centers))]
        dists = [d.alias(n) for d, n in zip(distances_columns(values, centers), named)]
        rows = given.select(*points.columns, F.coalesce(complete, F.lit(False)).alias("__complete"), *dists)
        nearest = first_least_columns([F.col(n) for n in named])
        return rows.withColumn(out, F.when(F.col("__complete"), nearest).otherwise(F.lit(-1)).cast("int")).drop("__complete", *named)
    return points.withColumn(
        out, F.when(features.complete(), features.nearest(centers)).otherwise(F.lit(-1)).cast("int")
    )
