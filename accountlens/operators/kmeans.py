"""K-Means with all restarts advanced together, in few passes over the points (``solver='batched'``).

The documented configuration runs 20 restarts (k-means++ seeding + Lloyd, variance-relative tolerance) and keeps the
lowest inertia. One pass over the data for each step of each restart would cost hundreds of scans, so a fit has two parts:

* **On a summary.** The space is cut into a regular grid; one aggregation gives the weight and the coordinate sums of every
  cell that holds points. The grid starts with ``FIRST_CELLS`` cells and is refined only while fewer than ``LEAST_CELLS`` of them hold
  points and some holds several, so their number is bounded at any size of the data. The driver runs greedy
  k-means++ and Lloyd for all restarts on the cells' means: first on cells merged to ``MERGED_CELLS`` at most, then on the
  cells as they are.
* **On all points.** One pass assigns all points to the centres of every distinct end: partitions add up weights, sums and squared
  distances with NumPy on Arrow batches, and ``groupBy(restart, cluster)`` reduces them to ``restarts x k`` rows that reach the
  driver. The end with the lowest inertia over all points is the winner, and Lloyd passes over all points move it
  until the stopping rule holds. As the cells' sums are exact, and only cells on a border between clusters can be assigned
  wrongly, it mostly holds at once.

Centres travel in the task closure, so the plan (and its generated code) stays the same across passes.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the per-partition functions run in Python workers: ship this module's code with them (by value), so the
# workers need only NumPy and pandas, not this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells of the first grid, the number that is fine enough, the most for seeding, and where refinement ends.
FIRST_CELLS = 1 << 18
LEAST_CELLS = 1024
MERGED_CELLS = 8192
MOST_BINS = 1 << 30
#: Tasks that add up partial sums: at most a row for each restart, cluster and partition comes in.
REDUCERS = 4


#: Partial sums are added as fixed-point decimals: exact, so neither the order of arrival nor the number of
#: partial rows can change a centre.
SUM_TYPE = "decimal(28,14)"


def _exact_sum(column: str):
    return F.sum(F.col(column).cast(SUM_TYPE)).alias(column)


def _sqdist(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """N x k squared distances."""
    diff = X[:, None, :] - C[None, :, :]
    return np.einsum("nkd,nkd->nk", diff, diff)


class Summary:
    """Grid cells that hold points, in the order of their bins: bins (cells x dimensions), weights and coordinate sums."""

    def __init__(self, bins: np.ndarray, weights: np.ndarray, sums: np.ndarray):
        order = np.lexsort(bins.T[::-1])
        self.bins, self.weights, self.sums = bins[order], weights[order], sums[order]

    @property
    def means(self) -> np.ndarray:
        return self.sums / self.weights[:, None]

    def merged(self, most: int) -> Summary:
        """Neighbouring cells as one, until there are at most ``most``."""
        out = self
        while len(out.weights) > most:
            bins, cell = np.unique(out.bins // 2, axis=0, return_inverse=True)
            cell = cell.ravel()
            sums = np.stack([np.bincount(cell, weights=s) for s in out.sums.T], axis=1)
            out = Summary(bins, np.bincount(cell, weights=out.weights), sums)
        return out


def summarise(points: DataFrame, cols: list[str], weight_col: str | None = None) -> Summary:
    """The summary of points whose coordinates are of the order of 1; identical points must be collapsed into one."""
    weight = F.col(weight_col) if weight_col else F.lit(1.0)
    bins = max(2, int(FIRST_CELLS ** (1 / len(cols)) + 1e-9))
    while True:
        cells = (points.groupBy(*[F.floor(F.col(c) * bins).cast("long").alias(f"b{i}") for i, c in enumerate(cols)])
                 .agg(F.count(F.lit(1)).alias("points"), F.sum(weight.cast(SUM_TYPE)).cast("double").alias("w"),
                      *[F.sum((F.col(c) * weight).cast(SUM_TYPE)).cast("double").alias(f"s{i}") for i, c in enumerate(cols)]))
        found = cells.toArrow()
        if len(found) >= LEAST_CELLS or bins >= MOST_BINS or not np.any(found["points"].to_numpy() > 1):
            break
        bins *= 2
    at, sums = ([found[f"{x}{i}"].to_numpy() for i in range(len(cols))] for x in "bs")
    return Summary(np.stack(at, axis=1), found["w"].to_numpy(), np.stack(sums, axis=1))


def seed_centres(X: np.ndarray, w: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Greedy k-means++: each centre is the best of ``2 + ln k`` draws by weight x D^2; fewer centres if points run out."""
    C = [X[rng.choice(len(X), p=w / w.sum())]]
    near = ((X - C[0]) ** 2).sum(axis=1)
    while len(C) < k and (near * w).sum() > 0:
        p = near * w
        drawn = rng.choice(len(X), size=2 + int(np.log(k)), p=p / p.sum())
        closer = np.minimum(near[None, :], _sqdist(X[drawn], X))
        best = int(np.argmin((closer * w).sum(axis=1)))
        C.append(X[drawn[best]])
        near = closer[best]
    return np.array(C)


def lloyd_on_summary(X: np.ndarray, w: np.ndarray, C: np.ndarray, max_iter: int) -> np.ndarray:
    """Lloyd steps on weighted points until nothing moves."""
    for _ in range(max_iter):
        label = np.argmin(_sqdist(X, C), axis=1)
        n = np.bincount(label, weights=w, minlength=len(C))
        sums = np.stack([np.bincount(label, weights=X[:, j] * w, minlength=len(C)) for j in range(X.shape[1])], axis=1)
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1e-300)[:, None], C)
        if np.array_equal(moved, C):
            break
        C = moved
    return C


def _lloyd_pass(points: DataFrame, cols: list[str], centres: dict, weight_col: str | None = None) -> dict:
    """Per (restart, cluster): weight, weighted coordinate sums and squared-distance sum w.r.t. ``centres``."""
    frozen = {r: np.asarray(c, dtype=np.float64) for r, c in centres.items()}

    def partial(batches):
        acc = {r: (np.zeros(len(C)), np.zeros((len(C), len(cols))), np.zeros(len(C))) for r, C in frozen.items()}
        for pdf in batches:
            if pdf.empty:
                continue
            X = pdf[cols].to_numpy(dtype=np.float64)
            w = pdf[weight_col].to_numpy(dtype=np.float64) if weight_col else np.ones(len(X))
            rows_idx = np.arange(len(X))
            for r, C in frozen.items():
                D = _sqdist(X, C)
                lab = np.argmin(D, axis=1)          # ties -> lowest index
                k = len(C)
                n, s, e = acc[r]
                n += np.bincount(lab, weights=w, minlength=k)
                for j in range(len(cols)):
                    s[:, j] += np.bincount(lab, weights=X[:, j] * w, minlength=k)
                e += np.bincount(lab, weights=D[rows_idx, lab] * w, minlength=k)
        rows = [(r, c, float(n[c]), *map(float, s[c]), float(e[c]))
                for r, (n, s, e) in acc.items() for c in range(len(n)) if n[c] > 0]
        yield pd.DataFrame(rows, columns=["restart", "cluster", "n", *[f"s_{c}" for c in cols], "sse"])

    schema = "restart int, cluster int, n double, " + ", ".join(f"s_{c} double" for c in cols) + ", sse double"
    partials = points.mapInPandas(partial, schema)
    agg = (partials.repartition(REDUCERS, "restart", "cluster").groupBy("restart", "cluster")
           .agg(_exact_sum("n"), *[_exact_sum(f"s_{c}") for c in cols], _exact_sum("sse"))
           .collect())
    return {(int(row["restart"]), int(row["cluster"])): (float(row["n"]), [float(row[f"s_{c}"]) for c in cols],
                                                         float(row["sse"])) for row in agg}


def lloyd(points: DataFrame, cols: list[str], centres: dict, max_iter: int, tol_abs: float,
          weight_col: str | None = None, first: dict | None = None) -> dict:
    """Lloyd steps from ``centres`` ({restart: list of points}), all restarts in each pass; returns the moved centres.

    A restart stops when its summed squared centre shift is <= ``tol_abs``; empty clusters keep their centre.
    ``first``: the sums of the first pass, if that has been made.
    """
    centres = dict(centres)
    active = set(centres)
    for step in range(max_iter):
        if not active:
            break
        stats = first if first and not step else _lloyd_pass(points, cols, {r: centres[r] for r in sorted(active)}, weight_col)
        for r in sorted(active):
            old = centres[r]
            new = []
            for c, centre in enumerate(old):
                n, s, _ = stats.get((r, c), (0, None, 0.0))
                new.append([x / n for x in s] if n else list(centre))
            shift = sum((a - b) ** 2 for cn, co in zip(new, old) for a, b in zip(cn, co))
            centres[r] = new
            if shift <= tol_abs:
                active.discard(r)
    return centres


def fit_batched(points: DataFrame, cols: list[str], k: int, n_init: int, max_iter: int,
                tol_abs: float, weight_col: str | None = None, seed: int = 0) -> tuple[list[list[float]], float]:
    """Fit ``n_init`` restarts together; returns the centres of the best one and its inertia before the last passes.

    ``points`` holds ``cols`` (complete rows only, identical ones collapsed) and optionally a weight column (a point of weight
    w counts as w identical rows). The winner converges when its summed squared centre shift is <= ``tol_abs``;
    empty clusters keep their centre. Ties in inertia go to the lowest restart. With fewer than ``k`` distinct points
    there are fewer centres.
    """
    fine = summarise(points, cols, weight_col)
    coarse = fine.merged(MERGED_CELLS)
    starts: dict[bytes, np.ndarray] = {}
    for r in range(n_init):
        C = seed_centres(coarse.means, coarse.weights, k, np.random.default_rng([seed, r]))
        C = lloyd_on_summary(coarse.means, coarse.weights, C, max_iter)
        if len(C) < min(k, len(fine.weights)):  # the merged cells ran out
            C = seed_centres(fine.means, fine.weights, k, np.random.default_rng([seed, r]))
        C = C[np.lexsort(C.T[::-1])]
        starts.setdefault(C.tobytes(), C)
    ends = [lloyd_on_summary(fine.means, fine.weights, C, max_iter).tolist() for C in starts.values()]
    first = _lloyd_pass(points, cols, dict(enumerate(ends)), weight_col)
    inertia = {r: sum(v[2] for (rr, _), v in first.items() if rr == r) for r in range(len(ends))}
    best = min(inertia, key=lambda r: (inertia[r], r))
    centres = lloyd(points, cols, {best: ends[best]}, max_iter, tol_abs, weight_col, first)
    return centres[best], inertia[best]
