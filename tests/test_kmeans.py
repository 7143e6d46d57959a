"""The batched K-Means solver: its summary, its passes and its cost against plain Lloyd in NumPy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from accountlens.operators import kmeans
from accountlens.operators import segmentation as seg
from accountlens.plans import catalog

COLS = ["a", "b", "c"]


def points(spark, X, weights=None, parts=4):
    df = spark.createDataFrame(pd.DataFrame(X, columns=COLS).assign(weight=1.0 if weights is None else weights))
    return df.groupBy(*COLS).agg({"weight": "sum"}).withColumnRenamed("sum(weight)", "weight").repartition(parts, *COLS)


def full_lloyd(X, C, tol):
    while True:
        label = np.argmin(((X[:, None, :] - C[None]) ** 2).sum(-1), axis=1)
        moved = np.array([X[label == j].mean(axis=0) if (label == j).any() else C[j] for j in range(len(C))])
        if ((moved - C) ** 2).sum() <= tol:
            return moved
        C = moved


def cost(X, C):
    return float(((X[:, None, :] - np.asarray(C)[None]) ** 2).sum(-1).min(axis=1).sum())


def test_a_summary_keeps_weights_and_sums(spark):
    rng = np.random.default_rng(1)
    X, w = rng.random((5000, 3)), rng.integers(1, 9, 5000).astype(float)
    fine = kmeans.summarise(points(spark, X, w), COLS, "weight")
    for s in (fine, fine.merged(600), fine.merged(1)):
        assert np.isclose(s.weights.sum(), w.sum()) and np.allclose(s.sums.sum(axis=0), (X * w[:, None]).sum(axis=0))
    assert len(fine.merged(600).weights) <= 600 and len(fine.merged(1).weights) == 1
    at = np.floor(fine.means * 64)
    assert (at == fine.bins).all()  # every mean lies in its own cell


def test_a_summary_is_refined_where_all_points_share_few_cells(spark):
    """One far point leaves all others in one cell of the first grid."""
    X = np.vstack([np.random.default_rng(2).random((3000, 3)) / 1000, [[1.0, 1.0, 1.0]]])
    fine = kmeans.summarise(points(spark, X), COLS, "weight")
    assert kmeans.LEAST_CELLS <= len(fine.weights) <= 2 ** 3 * kmeans.LEAST_CELLS
    few = kmeans.summarise(points(spark, X[:3]), COLS, "weight")
    assert len(few.weights) == 3 and np.allclose(np.sort(few.means, axis=0), np.sort(X[:3], axis=0))


@pytest.mark.parametrize("kind", ["flat", "lumps", "skewed", "lattice"])
def test_cost_equals_that_of_full_restarts(spark, kind):
    rng = np.random.default_rng(5)
    X = {"flat": lambda: rng.random((4000, 3)),
         "lumps": lambda: np.clip(rng.random((4, 3))[rng.integers(0, 4, 4000)] + rng.normal(0, 0.05, (4000, 3)), 0, 1),
         "skewed": lambda: np.minimum(rng.lognormal(-6, 1.5, (4000, 3)), 1),
         "lattice": lambda: rng.integers(0, 5, (4000, 3)) / 4}[kind]()
    tol = 1e-4 * X.var(axis=0).mean()
    best = min(cost(X, full_lloyd(X, kmeans.seed_centres(X, np.ones(len(X)), 4, np.random.default_rng(s)), tol)) for s in range(20))
    centres, _ = kmeans.fit_batched(points(spark, X), COLS, 4, 20, 500, tol, "weight", seed=42)
    assert cost(X, centres) <= best * 1.002
    moved = full_lloyd(X, np.array(centres), np.inf)
    assert ((moved - np.array(centres)) ** 2).sum() <= tol  # one more step over all points stands still


def test_a_fit_takes_few_jobs(spark, monkeypatch):
    passes = []
    real = kmeans._lloyd_pass
    monkeypatch.setattr(kmeans, "_lloyd_pass", lambda *a, **k: passes.append(1) or real(*a, **k))
    employers = catalog._emp(spark, "/root/testdata/sf0.01")
    sc = spark.sparkContext
    sc.setJobGroup("one fit", "K-Means")
    try:
        seg.fit_transform(employers, catalog.AS_OF, nullPolicy="keep")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(passes) <= 6
    assert len(sc.statusTracker().getJobIdsForGroup("one fit")) <= 20


def test_more_dimensions_and_one_restart(spark):
    X = np.random.default_rng(3).random((500, 3))
    centres, inertia = kmeans.fit_batched(points(spark, X), COLS, 3, 1, 500, 1e-6, "weight", seed=1)
    assert len(centres) == 3 and np.isclose(inertia, cost(X, centres), rtol=0.01)
    two = kmeans.summarise(points(spark, X).drop("c").groupBy("a", "b").agg({"weight": "sum"}).withColumnRenamed("sum(weight)", "weight"),
                           ["a", "b"], "weight")
    assert two.bins.shape[1] == 2 and np.isclose(two.weights.sum(), 500)
