"""Distance bounds, wide vectors and fits that go on after a stop."""

from __future__ import annotations

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from statforge.operators import kmeans as km


def _points(spark, rows, parts=3):
    return spark.createDataFrame([(r,) for r in rows], "x ARRAY<DOUBLE>").repartition(parts).cache()


def _plain(points, features, start, max_iter, tol, rule):
    """Rounds without bounds."""
    centers, out = [list(map(float, c)) for c in start], []
    for _ in range(max_iter):
        new, sizes, left_out = km.lloyd_step(points, features, centers)
        done = km.has_converged(centers, new, rule, tol)
        out.append((new, sizes, left_out, done))
        centers = new
        if done:
            break
    return out


def _blobs(rng, n, d, k, spread=0.3):
    middles = [[rng.uniform(-5, 5) for _ in range(d)] for _ in range(k)]
    return [[m + rng.gauss(0, spread) for m in rng.choice(middles)] for _ in range(n)]


@pytest.mark.parametrize("n, d, k, grid", [(300, 2, 4, False), (200, 1, 3, True), (250, 3, 6, True), (40, 2, 1, False), (30, 300, 3, False)])
def test_bounds_change_no_result(spark, n, d, k, grid):
    rng = random.Random(n + d)
    rows = _blobs(rng, n, d, k)
    if grid:  # many ties and equal rows
        rows = [[float(round(v)) for v in r] for r in rows]
    rows += [None, [float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [1.0] * (d + 1)]
    start = rows[:k]
    if k > 2:
        start[-1] = list(start[0])  # equal starts: the later one stays empty
    points, features = _points(spark, rows), km.Features(array="x", width=d)
    for rule, tol in (("max_abs", 1e-9), ("squared_shift", 1e-12)):
        want = _plain(points, features, start, 12, tol, rule)
        got = km.fit(points, features, start, max_iter=12, tol=tol, rule=rule)
        assert got.iterations == len(want) and got.converged == want[-1][3] and got.left_out == 4 == want[-1][2]
        assert [t["sizes"] for t in got.trace] == [w[1] for w in want]
        assert got.sizes == want[-1][1] and sum(got.sizes) == n
        for a, b in zip(got.centers, want[-1][0]):
            assert a == pytest.approx(b, rel=1e-12, abs=1e-12)


def test_bounds_save_distances(spark):
    rng = random.Random(3)
    rows = _blobs(rng, 2000, 2, 8, spread=0.8)
    result = km.fit(_points(spark, rows), km.Features(array="x", width=2), rows[:8], max_iter=15, tol=0.0)
    every = len(rows) * 8
    assert result.trace[0]["distances"] == every
    assert result.distances < 0.5 * every * result.iterations
    assert min(t["distances"] for t in result.trace) < 0.1 * every


def test_points_at_equal_distance_stay_with_the_first(spark):
    rows = [[0.0], [1.0], [2.0], [3.0], [4.0]] * 20
    result = km.fit(_points(spark, rows), km.Features(array="x", width=1), [[1.0], [3.0]], max_iter=1)
    assert result.sizes == [60, 40]


def test_written_frames_give_the_same_fit(spark):
    rng = random.Random(9)
    rows = _blobs(rng, 300, 3, 4)
    points, features = _points(spark, rows), km.Features(array="x", width=3)
    a, b = (km.fit(points, features, rows[:4], max_iter=10, tol=1e-9, cache=c) for c in ("persist", "checkpoint"))
    assert a.centers == b.centers and a.sizes == b.sizes and a.iterations == b.iterations
    with pytest.raises(ValueError):
        km.fit(points, features, rows[:4], cache="none")


def test_wide_vectors(spark):
    d, rng = 4096, random.Random(4)
    rows = _blobs(rng, 24, d, 2)
    points, features = _points(spark, rows, 2), km.Features(array="x", width=d)
    result = km.fit(points, features, rows[:2], max_iter=3)
    best = [min(range(2), key=lambda j: (math.dist(r, rows[j]), j)) for r in rows]
    first = [[sum(r[i] for r, b in zip(rows, best) if b == j) / best.count(j) for i in range(d)] for j in range(2)]
    one = km.fit(points, features, rows[:2], max_iter=1)
    assert one.sizes == [best.count(0), best.count(1)]
    assert all(a == pytest.approx(b, rel=1e-12, abs=1e-12) for a, b in zip(one.centers, first))
    assert sum(result.sizes) == 24


def test_wide_sums_are_partial(spark):
    frame = spark.range(10).select(F.lit(0).alias("cluster"), F.lit(1).alias("cost"), F.array_repeat(F.lit(1.0), 300).alias("x"))
    plan = km._cluster_means(frame, 300)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate") >= 2 and "partial_" in plan


# --------------------------------------------------------------------------- going on after a stop
def _same(a, b):
    drop = lambda t: {k: v for k, v in t.items() if k not in ("seconds", "distances")}
    assert a.centers == b.centers and a.sizes == b.sizes and a.iterations == b.iterations and a.converged == b.converged and a.left_out == b.left_out
    assert [drop(t) for t in a.trace] == [drop(t) for t in b.trace]


@pytest.fixture()
def problem(spark):
    rng = random.Random(11)
    rows = _blobs(rng, 400, 2, 5, spread=1.5)
    return _points(spark, [*rows, None]), km.Features(array="x", width=2), rows[:5]


def test_fit_goes_on_after_the_rounds_that_are_there(spark, workdir, problem):
    points, features, start = problem
    state = f"file://{workdir}/state"
    whole = km.fit(points, features, start, max_iter=20, tol=1e-9)
    assert whole.iterations > 4
    first = km.fit(points, features, start, max_iter=3, tol=1e-9, state=state)
    assert first.iterations == 3 and not first.converged
    _same(km.fit(points, features, start, max_iter=20, tol=1e-9, state=state), whole)
    # all rounds are there now: nothing is computed again
    again = km.fit(points.where("false"), features, start, max_iter=20, tol=1e-9, state=state)
    _same(again, whole)
    _same(km.fit(points, features, start, max_iter=3, tol=1e-9, state=state), first)


def test_driver_lost_in_a_round(spark, workdir, problem, monkeypatch):
    points, features, start = problem
    state = f"file://{workdir}/state"
    whole = km.fit(points, features, start, max_iter=20, tol=1e-9)
    step, calls = km.BoundedRounds.step, []

    def fails(self, centers):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("lost")
        return step(self, centers)

    monkeypatch.setattr(km.BoundedRounds, "step", fails)
    with pytest.raises(RuntimeError):
        km.fit(points, features, start, max_iter=20, tol=1e-9, state=state)
    assert sorted(os.listdir(f"{workdir}/state")) == [f"round-{i:06d}" for i in (1, 2, 3)]
    # the fourth round was half written
    one = spark.read.parquet(f"{state}/round-000003").where("cluster < 2")
    one.withColumn("iteration", F.lit(4)).write.parquet(f"{state}/round-000004")
    monkeypatch.setattr(km.BoundedRounds, "step", step)
    _same(km.fit(points, features, start, max_iter=20, tol=1e-9, state=state), whole)


def test_rounds_of_another_fit_are_refused(spark, workdir, problem):
    points, features, start = problem
    state = f"file://{workdir}/state"
    km.fit(points, features, start, max_iter=1, state=state)
    for other in ({"tol": 0.5}, {"rule": "squared_shift"}, {"start": start[::-1]}):
        with pytest.raises(ValueError, match="another fit"):
            km.fit(points, features, other.pop("start", start), max_iter=2, state=state, **other)


# --------------------------------------------------------------------------- short centroids, written out
def test_short_centroids_keep_primitive_columns_and_compiled_rounds(spark):
    rng = random.Random(5)
    rows = _blobs(rng, 60, 3, 4)
    rounds = km.BoundedRounds(_points(spark, rows), km.Features(array="x", width=3), km._kept("persist"), 4)
    rounds.step(rows[:4])
    assert dict(rounds.frame.dtypes) == {"x0": "double", "x1": "double", "x2": "double", "cluster": "int", "upper": "double", "lower": "double"}
    plan = km._cluster_means(rounds._assigned(rows[4:8]), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
    rounds.free()


@pytest.mark.parametrize("k, d", [(1, 1), (1, 3), (4, 3), (6, 2)])
def test_written_out_form_equals_array_form(spark, monkeypatch, k, d):
    rng, nan, inf = random.Random(k * 10 + d), float("nan"), float("inf")
    rows = [[float(round(v)) for v in r] for r in _blobs(rng, 120, d, k)]
    start = rows[:k]
    rows += [None, [], [nan] * d, [inf] * d, [-inf] * d, [1.0] * (d + 1), [None] * d, [nan] + [1.0] * (d - 1), [1e200] * d]
    points, features = _points(spark, rows), km.Features(array="x", width=d)

    def found():
        fit = km.fit(points, features, start, max_iter=6, tol=1e-9)
        labels = km.assign(points, features, fit.centers)
        assert labels.columns == ["x", "cluster"] and labels.schema["cluster"].dataType.simpleString() == "int"
        counts = [[t[c] for c in ("sizes", "distances", "squared_shifts")] for t in fit.trace]
        return fit.centers, fit.left_out, counts, [(str(r["x"]), r["cluster"]) for r in labels.collect()]

    written_out = found()
    monkeypatch.setattr(km, "UNROLLED", 0)
    assert written_out == found()


def test_assignment_of_short_centroids_is_compiled(spark):
    frame = spark.range(5).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    plan = km.assign(frame, km.Features(array="x", width=2), [[0.0, 1.0], [4.0, 1.0]])._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan


def test_points_kept_for_a_fit_are_freed_after_its_first_round(spark, monkeypatch):
    rng = random.Random(8)
    rows, done = _blobs(rng, 50, 2, 3), []
    step = km.BoundedRounds.step

    def noted(self, centers):
        found = step(self, centers)
        done.append("round")
        return found

    monkeypatch.setattr(km.BoundedRounds, "step", noted)
    result = km.fit(_points(spark, rows), km.Features(array="x", width=2), rows[:3], max_iter=4, tol=0.0, free_points=lambda: done.append("freed"))
    assert done.count("freed") == 1 and done.index("freed") == 0 and result.sizes and sum(result.sizes) == 50


def test_given_start_needs_no_sample_key(spark, monkeypatch):
    from statforge.plans import clustering

    def unwanted(*_):
        raise AssertionError("ranked")

    monkeypatch.setattr(clustering, "placed_rank", unwanted)
    lines = spark.createDataFrame([(f"{i % 7}\t{i % 5}",) for i in range(40)], "value STRING")
    result = clustering.run_clustering(lines, 2, 5, variables=(0, 1), init_centers_raw=[[0.0, 0.0], [6.0, 4.0]], width=2)
    assert sum(result.fit.sizes) == 40
    with pytest.raises(Exception, match="wider than 1"):
        clustering.run_clustering(lines, 2, 5, variables=(0,), init_centers_raw=[[0.0], [6.0]], width=1)
