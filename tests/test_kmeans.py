"""k-means: Spark fit against a brute-force NumPy Lloyd loop, and the edge cases."""

from __future__ import annotations

import numpy as np
import pytest

from statforge.operators import kmeans as km
from statforge.plans import jobs
from statforge.plans.clustering import run_clustering
from tests.conftest import lines


def lloyd(points, centers, max_iter, tol, rule):
    """Reference loop: strict-< nearest (ties to the lowest index), empty
    clusters keep their centroid, stop on the convergence rule."""
    c = np.array(centers, dtype=float)
    it, conv = 0, False
    while not conv and it < max_iter:
        d = np.sqrt(((points[:, None, :] - c[None, :, :]) ** 2).sum(axis=2))
        lab = d.argmin(axis=1)
        new = c.copy()
        for j in range(len(c)):
            if (lab == j).any():
                new[j] = points[lab == j].mean(axis=0)
        if rule == "max_abs":
            conv = np.abs(new - c).max() <= tol
        else:
            conv = (((new - c) ** 2).sum(axis=1) <= tol).all()
        c, it = new, it + 1
    return c, it, conv


def _blobs(seed=7, n=300, d=3):
    rng = np.random.default_rng(seed)
    means = np.array([[0, 0, 0], [6, 6, 0], [0, 6, 6]], dtype=float)[:, :d]
    pts = np.vstack([m + rng.normal(size=(n // 3, d)) for m in means])
    return np.round(pts, 4)


def test_raw_fit_matches_numpy(spark):
    pts = _blobs()
    recs = [" ".join(f"{x}" for x in p) for p in pts]
    start = pts[[0, 1, 2]].tolist()
    res = jobs.kmeans_raw(lines(spark, recs), start, [0, 1, 2], max_iter=10, tol=0.01)
    c, it, conv = lloyd(pts, start, 10, 0.01, "max_abs")
    assert res.iterations == it and res.converged == conv
    np.testing.assert_allclose(res.centers, c, rtol=1e-9, atol=1e-9)
    assert sum(res.sizes) == len(pts)


def test_standardised_fit_matches_numpy(spark):
    pts = _blobs(seed=3)
    recs = ["\t".join(["id"] + [f"{x}" for x in p]) for p in pts]
    means, stds = [float("nan")] + pts.mean(axis=0).tolist(), [float("nan")] + pts.std(axis=0).tolist()
    start = pts[[5, 150, 250]].tolist()
    res = jobs.kmeans_standardised(lines(spark, recs), start, [1, 2, 3], means, stds, max_iter=20)
    z = (pts - pts.mean(axis=0)) / pts.std(axis=0)
    zs = (np.array(start) - pts.mean(axis=0)) / pts.std(axis=0)
    c, it, conv = lloyd(z, zs, 20, 0.01, "squared_shift")
    assert res.iterations == it and res.converged == conv
    np.testing.assert_allclose(res.centers, c, rtol=1e-9, atol=1e-9)
    assert f"after iteration {it}" in res.report() and "0 rows left out" in res.report()


def test_tie_goes_to_lowest_index(spark):
    # (1, 0) is equally far from both centroids: the lower index wins either way round
    for centers in ([[0.0, 0.0], [2.0, 0.0]], [[2.0, 0.0], [0.0, 0.0]]):
        res = jobs.assign_clusters(lines(spark, ["1 0"]), centers, [0, 1], delimiter=r"\s+")
        assert res.first()["cluster"] == 0


def test_empty_cluster_keeps_centroid(spark):
    recs = ["0 0", "0 1", "1 0"]
    res = jobs.kmeans_raw(lines(spark, recs), [[0.0, 0.0], [100.0, 100.0]], [0, 1], max_iter=3)
    assert res.centers[1] == [100.0, 100.0]
    assert res.sizes == [3, 0]


def test_converged_start_stops_after_one_iteration(spark):
    recs = ["0 0", "0 2", "10 10", "10 12"]
    res = jobs.kmeans_raw(lines(spark, recs), [[0.0, 1.0], [10.0, 11.0]], [0, 1], max_iter=10)
    assert res.iterations == 1 and res.converged
    assert res.trace[0]["max_abs_shift"] == 0.0 and res.trace[0]["seconds"] > 0


def test_short_vector_goes_to_minus_one_and_is_left_out_of_fit(spark):
    recs = ["1\t1", "1", "2\t2"]
    out = {r["value"]: r["cluster"] for r in jobs.assign_clusters(lines(spark, recs), [[1.0, 1.0], [2.0, 2.0]], [0, 1]).collect()}
    assert out == {"1\t1": 0, "1": -1, "2\t2": 1}
    res = jobs.kmeans_raw(lines(spark, recs), [[1.0, 1.0], [2.0, 2.0]], [0, 1], delimiter="\t")
    assert sum(res.sizes) == 2 and res.left_out == 1


def test_non_finite_rows_are_left_out_and_counted(spark):
    recs = ["0 0", "0 1", "Infinity 1", "NaN 2", "10 -Infinity", "10 10", "10 11"]
    res = jobs.kmeans_raw(lines(spark, recs), [[0.0, 0.0], [10.0, 10.0]], [0, 1], max_iter=5)
    assert res.left_out == 3 and res.sizes == [2, 2]
    assert res.centers == [[0.0, 0.5], [10.0, 10.5]]


def test_forty_centroids_of_sixty_fields(spark):
    recs = [" ".join(str((i * 31 + j * 17) % 101) for j in range(60)) for i in range(200)]
    start = [[float((i * 31 + j * 17) % 101) for j in range(60)] for i in range(40)]
    res = jobs.kmeans_raw(lines(spark, recs), start, list(range(60)), max_iter=2)
    assert sum(res.sizes) == 200


def test_nan_vector_assigned_to_zero(spark):
    out = jobs.assign_clusters(lines(spark, ["NaN\t1"]), [[5.0, 5.0], [1.0, 1.0]], [0, 1]).first()
    assert out["cluster"] == 0


def test_bad_start_rejected(spark):
    with pytest.raises(ValueError):
        jobs.kmeans_raw(lines(spark, ["1 1"]), [[1.0]], [0, 1])
    with pytest.raises(ValueError):
        jobs.kmeans_raw(lines(spark, ["1 1"]), [[float("nan"), 1.0]], [0, 1])


def test_constant_column_rejected(spark):
    with pytest.raises(ValueError, match="constant"):
        jobs.kmeans_standardised(lines(spark, ["1\t1"]), [[1.0]], [0], [1.0], [0.0], max_iter=2)


def test_array_features_match_columns(spark):
    pts = _blobs(seed=11)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "id INT, v ARRAY<DOUBLE>")
    start = pts[[0, 100, 200]].tolist()
    res = km.fit(df, km.Features(array="v", width=3), start, max_iter=10, tol=0.01)
    c, it, _ = lloyd(pts, start, 10, 0.01, "max_abs")
    assert res.iterations == it
    np.testing.assert_allclose(res.centers, c, rtol=1e-9, atol=1e-9)


def test_clustering_end_to_end(spark):
    pts = _blobs(seed=5)
    recs = ["\t".join(["r"] + [f"{x}" for x in p]) for p in pts]
    res = run_clustering(lines(spark, recs), k=3, max_iter=20, variables=[1, 2, 3])
    sizes = {r["cluster"]: r["n"] for r in res.cluster_sizes().collect()}
    assert sum(sizes.values()) == len(pts)
    # same start, checked against the NumPy loop
    z = (pts - pts.mean(axis=0)) / pts.std(axis=0)
    zs = (np.array(res.init_centers_raw) - pts.mean(axis=0)) / pts.std(axis=0)
    c, it, _ = lloyd(z, zs, 20, 0.01, "squared_shift")
    np.testing.assert_allclose(res.fit.centers, c, rtol=1e-9, atol=1e-9)
    assert res.fit.iterations == it


def test_clustering_given_moments(spark):
    pts = _blobs(seed=9)
    recs = ["\t".join(["r"] + [f"{x}" for x in p]) for p in pts]
    full = jobs.column_moments(lines(spark, recs))
    res = run_clustering(lines(spark, recs), k=3, max_iter=5, variables=[1, 2, 3], moments=full)
    assert res.assignments.count() == len(pts)
    assert res.assignments.where("cluster < 0").count() == 0


def test_checkpointed_fit_equals_persisted_fit(spark):
    pts = _blobs(seed=13)
    df = spark.createDataFrame([tuple(map(float, p)) for p in pts], "x0 DOUBLE, x1 DOUBLE, x2 DOUBLE")
    feats = km.Features(columns=("x0", "x1", "x2"))
    start = pts[[0, 120, 240]].tolist()
    a = km.fit(df, feats, start, max_iter=10, cache="persist")
    b = km.fit(df, feats, start, max_iter=10, cache="checkpoint")
    assert a.iterations == b.iterations
    np.testing.assert_allclose(a.centers, b.centers, rtol=1e-12, atol=1e-12)


def test_clustering_checkpoint_cache_and_width_check(spark):
    pts = _blobs(seed=21)
    recs = ["\t".join(["r"] + [f"{x}" for x in p]) for p in pts]
    a = run_clustering(lines(spark, recs), k=3, max_iter=20, variables=[1, 2, 3])
    b = run_clustering(lines(spark, recs), k=3, max_iter=20, variables=[1, 2, 3], cache="checkpoint", width=4)
    assert a.init_centers_raw == b.init_centers_raw and a.fit.iterations == b.fit.iterations
    np.testing.assert_allclose(a.fit.centers, b.fit.centers, rtol=1e-12, atol=1e-12)
    with pytest.raises(Exception, match="wider than 4"):
        run_clustering(lines(spark, recs + ["r\t1\t2\t3\textra"]), k=3, max_iter=2, variables=[1, 2, 3], width=4)
