"""RFM scoring and K-Means segmentation (SEG1-SEG12) as a ``pyspark.ml`` Estimator/Model.

Plan shape
----------
fit:
  1. the three RFM inputs are derived once (checkpoint); one aggregation gives
     their min / max / variance and the row and null counts -> 1 row to the driver;
  2. the complete rows' score points are collapsed into (point, weight) by a
     partial count, hash-partitioned on the point into a count derived from
     the row count, sorted and checkpointed to the shared checkpoint folder
     (placement independent of the input => repeatable K-Means; lost executors
     recompute from the checkpoint, not from the sources);
  3. K-Means with ``nInit`` restarts: by default on a bounded summary and then
     in few passes over all points (``kmeans.fit_batched``), or one MLlib
     k-means|| fit per restart (``solver='mllib'``); the lowest cost wins;
  4. one aggregation of mean rfm_score per cluster -> k rows to the driver.
transform:
  a single narrow projection: scaling, nearest-centre assignment, segment
  lookup and priority score are literal-parameterised native expressions
  (no join, no UDF, whole-stage codegen).
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasMaxIter, HasSeed, HasTol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens import constants as C
from accountlens.functions.expressions import clip, nan_to_null, round_half_even, whole_days_since
from accountlens.operators.kmeans import fit_batched, lloyd
from accountlens.session import materialize

RFM_INPUTS = ["recency_days", "frequency_12m", "revenue_potential"]
SCORE_COLS = ["r_score", "f_score", "m_score"]


# ---------------------------------------------------------------------------
# SEG1-SEG3: raw RFM dimensions
# ---------------------------------------------------------------------------

def estimate_revenue_potential(df: DataFrame) -> Column:
    """SEG3: round(base(size) x multiplier(sector), 0); both columns are required."""
    missing = [c for c in ("company_size", "sector") if c not in df.columns]
    if missing:
        raise ValueError(f"revenue potential needs columns {missing}")
    size_map = F.create_map(*[x for k, v in C.SIZE_BASE_REVENUE.items() for x in (F.lit(k), F.lit(float(v)))])
    mult_map = F.create_map(*[x for k, v in C.SECTOR_MULTIPLIER.items() for x in (F.lit(k), F.lit(float(v)))])
    base = F.coalesce(F.try_element_at(size_map, F.col("company_size")), F.lit(C.DEFAULT_BASE_REVENUE))
    mult = F.coalesce(F.try_element_at(mult_map, F.col("sector")), F.lit(C.DEFAULT_SECTOR_MULTIPLIER))
    return round_half_even(base * mult, 0)


def compute_rfm(df: DataFrame, as_of, last_contact_col: str = "last_contact_date") -> DataFrame:
    """SEG1 recency (whole days, floored), SEG2 frequency fallback, SEG3 monetary fallback."""
    out = df.withColumn("recency_days", whole_days_since(df, last_contact_col, as_of))
    if "frequency_12m" not in df.columns:
        if "total_interactions" in df.columns:
            out = out.withColumn("frequency_12m", F.col("total_interactions").cast("long"))
        else:
            out = out.withColumn("frequency_12m", F.lit(1).cast("long"))
    if "revenue_potential" not in df.columns:
        out = out.withColumn("revenue_potential", estimate_revenue_potential(df))
    return out


# ---------------------------------------------------------------------------
# SEG4-SEG6: min-max scaling and the weighted score
# ---------------------------------------------------------------------------

def _scaled(x: Column, lo, hi) -> Column:
    """(x - min) / (max - min); a constant column maps to 0 (not 0.5 as in MLlib's MinMaxScaler)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo).cast("double")
    hi_c = hi if isinstance(hi, Column) else F.lit(hi).cast("double")
    x = nan_to_null(x)
    return F.when(hi_c == lo_c, F.when(x.isNotNull(), F.lit(0.0))).otherwise((x - lo_c) / (hi_c - lo_c))


def scale_minmax(df: DataFrame, cols) -> DataFrame:
    """SEG4: ``{col}_scaled`` in [0, 1] from one aggregated row of min/max (entered as literals)."""
    row = minmax_stats(df, cols).first()
    return df.withColumns({f"{c}_scaled": _scaled(F.col(c), row[f"__min_{c}"], row[f"__max_{c}"]) for c in cols})


def rfm_score_expr(r: Column, f: Column, m: Column) -> Column:
    w = C.RFM_WEIGHTS
    return round_half_even(r * F.lit(w["r"]) + f * F.lit(w["f"]) + m * F.lit(w["m"]), C.RFM_DIGITS)


def _with_scores(df: DataFrame, lows: list, highs: list) -> DataFrame:
    rec, freq, mon = (F.col(c) for c in RFM_INPUTS)
    r = F.lit(1.0) - _scaled(rec, lows[0], highs[0])
    f = _scaled(freq, lows[1], highs[1])
    m = _scaled(mon, lows[2], highs[2])
    return (df.withColumn("r_score", r).withColumn("f_score", f).withColumn("m_score", m)
            .withColumn("rfm_score", rfm_score_expr(F.col("r_score"), F.col("f_score"), F.col("m_score"))))


def minmax_stats(df: DataFrame, cols=RFM_INPUTS) -> DataFrame:
    """One-row aggregate of min and max per column (NaN treated as missing)."""
    aggs = []
    for c in cols:
        v = nan_to_null(F.col(c))
        aggs += [F.min(v).alias(f"__min_{c}"), F.max(v).alias(f"__max_{c}")]
    return df.agg(*aggs)


def normalize_rfm(df: DataFrame) -> DataFrame:
    """SEG4-SEG6: min and max come from one aggregated row and enter the plan as literals."""
    row = minmax_stats(df).first()
    lows = [row[f"__min_{c}"] for c in RFM_INPUTS]
    highs = [row[f"__max_{c}"] for c in RFM_INPUTS]
    return _with_scores(df, lows, highs)


# ---------------------------------------------------------------------------
# SEG7 helpers: nearest-centre assignment as a native expression
# ---------------------------------------------------------------------------

def nearest_centre_expr(centres: list[list[float]], cols=SCORE_COLS) -> Column:
    """Index of the nearest centre (squared Euclidean distance, ties -> lowest index)."""
    if len(centres) == 1:
        return F.lit(0)
    # as text: hundreds of small column calls cost the driver more than the query itself
    dists = ", ".join(" + ".join(f"(`{col}` - {float(v)!r}D) * (`{col}` - {float(v)!r}D)" for col, v in zip(cols, c))
                      for c in centres)
    return F.expr(f"CAST(array_position(array({dists}), array_min(array({dists}))) - 1 AS INT)")


# ---------------------------------------------------------------------------
# SEG8-SEG10
# ---------------------------------------------------------------------------

def rank_clusters(df: DataFrame, cluster_col: str = "cluster", score_col: str = "rfm_score",
                  max_clusters: int = C.MAX_SEGMENTS) -> dict[int, int]:
    """SEG8: cluster -> segment rank by mean rfm_score descending (ties by cluster id).

    At most ``max_clusters`` + 1 aggregated rows reach the driver; more distinct
    clusters than segments is an error.
    """
    rows = (df.filter(F.col(cluster_col).isNotNull())
            .groupBy(cluster_col).agg(F.avg(score_col).alias("mean_score"))
            .limit(max_clusters + 1).collect())
    if len(rows) > max_clusters:
        raise ValueError(f"more than {max_clusters} clusters; only {max_clusters} segments are defined")
    ordered = sorted(rows, key=lambda r: (-(r["mean_score"] if r["mean_score"] is not None else -math.inf),
                                          r[cluster_col]))
    return {int(r[cluster_col]): i for i, r in enumerate(ordered)}


def _lookup(mapping: dict, key: Column, value_type: str) -> Column:
    if not mapping:
        return F.lit(None).cast(value_type)
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, key).cast(value_type)


def apply_segments(df: DataFrame, rank_map: dict[int, int], cluster_col: str = "cluster") -> DataFrame:
    """SEG8 + SEG9: segment id from the rank map, then name / priority / action of that segment."""
    seg_id = _lookup(rank_map, F.col(cluster_col), "int")
    out = df.withColumn("segment_id", seg_id)
    sid = F.col("segment_id")
    return (out.withColumn("segment_name", _lookup({s[0]: s[1] for s in C.SEGMENTS}, sid, "string"))
            .withColumn("segment_priority", _lookup({s[0]: s[3] for s in C.SEGMENTS}, sid, "int"))
            .withColumn("segment_action", _lookup({s[0]: s[4] for s in C.SEGMENTS}, sid, "string")))


def priority_score_expr(rfm: Column, recency: Column, f_score: Column) -> Column:
    """SEG10: round(100 * clip(0.5(1-rfm) + 0.3 clip(recency/365, 0, 1) + 0.2(1-f), 0, 1), 1)."""
    w = C.PRIORITY_WEIGHTS
    raw = ((F.lit(1.0) - rfm) * F.lit(w["rfm"])
           + clip(recency.cast("double") / F.lit(float(C.PRIORITY_RECENCY_DAYS)), 0, 1) * F.lit(w["recency"])
           + (F.lit(1.0) - f_score) * F.lit(w["frequency"]))
    return round_half_even(clip(raw, 0, 1) * F.lit(100.0), C.PRIORITY_DIGITS)


def add_priority_score(df: DataFrame) -> DataFrame:
    return df.withColumn("priority_score",
                         priority_score_expr(F.col("rfm_score"), F.col("recency_days"), F.col("f_score")))


def segment_sizes(df: DataFrame) -> DataFrame:
    """SEG12: number of employers per segment."""
    return df.groupBy("segment_name").agg(F.count(F.lit(1)).cast("long").alias("count"))


# ---------------------------------------------------------------------------
# SEG11: Estimator / Model
# ---------------------------------------------------------------------------

class _SegmenterParams(HasSeed, HasMaxIter, HasTol):
    nSegments = Param(Params._dummy(), "nSegments", "number of segments (1..4)",
                      typeConverter=TypeConverters.toInt)
    nInit = Param(Params._dummy(), "nInit", "K-Means restarts; the lowest cost wins",
                  typeConverter=TypeConverters.toInt)
    asOf = Param(Params._dummy(), "asOf", "reference date (ISO) for recency", typeConverter=TypeConverters.toString)
    lastContactCol = Param(Params._dummy(), "lastContactCol", "last contact column",
                           typeConverter=TypeConverters.toString)
    nullPolicy = Param(Params._dummy(), "nullPolicy", "'error' or 'keep' for rows with a null RFM input",
                       typeConverter=TypeConverters.toString)
    rowsPerPartition = Param(Params._dummy(), "rowsPerPartition", "fit rows per partition",
                             typeConverter=TypeConverters.toInt)
    parallelism = Param(Params._dummy(), "parallelism", "MLlib restarts fitted concurrently",
                        typeConverter=TypeConverters.toInt)
    solver = Param(Params._dummy(), "solver", "'batched' (all restarts per data pass) or 'mllib' (one MLlib KMeans per restart)",
                   typeConverter=TypeConverters.toString)
    startCentres = Param(Params._dummy(), "startCentres", "nSegments score points to start from, in place of nInit "
                         "seeded restarts (batched solver)", typeConverter=TypeConverters.toList)

    def __init__(self):
        super().__init__()
        self._setDefault(nSegments=C.KMEANS_N_SEGMENTS, nInit=C.KMEANS_N_INIT, seed=C.KMEANS_SEED,
                         maxIter=C.KMEANS_MAX_ITER, tol=1e-4,
                         lastContactCol="last_contact_date", nullPolicy="error",
                         rowsPerPartition=50_000, parallelism=8, solver="batched")


class RFMSegmenter(Estimator, _SegmenterParams, DefaultParamsWritable, DefaultParamsReadable):
    """Fits RFM scaling, K-Means and the cluster ranking; see module docstring for the plan.

    ``save(path)`` and ``RFMSegmenter.load(path)`` keep the parameters.
    """

    @keyword_only
    def __init__(self, *, asOf=None, nSegments=None, nInit=None, seed=None, maxIter=None, tol=None,
                 lastContactCol=None, nullPolicy=None, rowsPerPartition=None, parallelism=None,
                 solver=None, startCentres=None):
        super().__init__()
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        if "asOf" in kwargs:
            kwargs["asOf"] = str(kwargs["asOf"])
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> "RFMSegmenterModel":
        k = self.getOrDefault("nSegments")
        if not 1 <= k <= C.MAX_SEGMENTS:
            raise ValueError(f"nSegments must be in 1..{C.MAX_SEGMENTS}, got {k}")
        if not self.isDefined("asOf") or not self.isSet("asOf"):
            raise ValueError("asOf is required: recency is relative to an explicit date")
        as_of = self.getOrDefault("asOf")
        policy = self.getOrDefault("nullPolicy")
        if policy not in ("error", "keep"):
            raise ValueError("nullPolicy must be 'error' or 'keep'")
        if self.isSet("startCentres"):
            start = self.getOrDefault("startCentres")
            if len(start) != k or any(len(c) != len(SCORE_COLS) for c in start):
                raise ValueError(f"startCentres must be {k} points of {len(SCORE_COLS)} scores")
            if self.getOrDefault("solver") != "batched":
                raise ValueError("startCentres needs the batched solver")

        feats = compute_rfm(dataset, as_of, self.getOrDefault("lastContactCol"))
        # the fit reads its inputs several times (stats, K-Means, ranking): derive them once
        feats = materialize(feats.select(*RFM_INPUTS))
        complete = _complete(RFM_INPUTS)
        stats_row = feats.agg(
            *[F.min(nan_to_null(F.col(c))).alias(f"min_{c}") for c in RFM_INPUTS],
            *[F.max(nan_to_null(F.col(c))).alias(f"max_{c}") for c in RFM_INPUTS],
            *[F.var_pop(F.when(complete, nan_to_null(F.col(c)))).alias(f"var_{c}") for c in RFM_INPUTS],
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~complete).alias("n_incomplete"),
        ).first()
        n_rows, n_bad = int(stats_row["n_rows"]), int(stats_row["n_incomplete"])
        if n_bad and policy == "error":
            raise ValueError(f"{n_bad} rows have a null recency, frequency or revenue potential; "
                             "clean them or use nullPolicy='keep'")
        n_fit = n_rows - n_bad
        if n_fit < k:
            raise ValueError(f"n_samples={n_fit} should be >= n_clusters={k}")
        lows = [stats_row[f"min_{c}"] for c in RFM_INPUTS]
        highs = [stats_row[f"max_{c}"] for c in RFM_INPUTS]
        scored = _with_scores(feats, lows, highs).filter(complete)

        if k == 1:
            centres = [[0.0, 0.0, 0.0]]
        else:
            tol_abs = _abs_tolerance(self.getOrDefault("tol"), stats_row, lows, highs)
            if self.getOrDefault("solver") == "mllib":
                eps = max(math.sqrt(tol_abs / k), 1e-12)
                centres = self._fit_kmeans(scored, n_fit, k, eps)
            else:
                centres = self._fit_batched(scored, n_fit, k, tol_abs)
        assigned = scored.withColumn("cluster", nearest_centre_expr(centres))
        rank_map = rank_clusters(assigned)
        model = RFMSegmenterModel(lows=lows, highs=highs, centres=centres, rank_map=rank_map)
        self._copyValues(model)
        return model

    def _n_parts(self, n_fit: int) -> int:
        return max(1, math.ceil(n_fit / self.getOrDefault("rowsPerPartition")))

    def _weighted_points(self, scored: DataFrame, n_fit: int) -> DataFrame:
        """Identical score points collapsed into (point, weight): exact for K-Means, and copies of one
        row (however many) become a single weighted point after a map-side partial count.

        Placement depends on the point values only: hash-partitioned into a count derived from the
        row count and sorted, so fits are repeatable whatever the upstream partitioning.
        """
        n_parts = self._n_parts(n_fit)
        pts = scored.groupBy(*SCORE_COLS).agg(F.count(F.lit(1)).cast("double").alias("weight"))
        return pts.repartition(n_parts, *SCORE_COLS).sortWithinPartitions(*SCORE_COLS)

    def _fit_batched(self, scored: DataFrame, n_fit: int, k: int, tol_abs: float) -> list[list[float]]:
        """All restarts together (see ``kmeans``); draws depend on the points and the seed, not on placement."""
        pts = materialize(self._weighted_points(scored, n_fit)).cache()
        try:
            if self.isSet("startCentres"):
                start = {0: [list(map(float, c)) for c in self.getOrDefault("startCentres")]}
                return lloyd(pts, SCORE_COLS, start, self.getOrDefault("maxIter"), tol_abs, "weight")[0]
            centres, _ = fit_batched(pts, SCORE_COLS, k, max(1, self.getOrDefault("nInit")),
                                     self.getOrDefault("maxIter"), tol_abs, "weight", self.getOrDefault("seed"))
        finally:
            pts.unpersist()
        return centres

    def _fit_kmeans(self, scored: DataFrame, n_fit: int, k: int, eps: float) -> list[list[float]]:
        pts = materialize(self._weighted_points(scored, n_fit))
        n_points = pts.count()  # distinct points; cheap on the checkpoint
        if n_points <= 1:
            row = pts.first()
            return [[float(row[c]) for c in SCORE_COLS]]
        k = min(k, n_points)    # MLlib fails with fewer points than centres; only existing clusters are ranked
        vectors = VectorAssembler(inputCols=SCORE_COLS, outputCol="features").transform(pts).select("features", "weight")
        vectors = vectors.cache()
        seed0 = self.getOrDefault("seed")
        seeds = [seed0 + i for i in range(max(1, self.getOrDefault("nInit")))]

        def fit_one(s):
            km = KMeans(k=k, seed=s, maxIter=self.getOrDefault("maxIter"), tol=eps,
                        featuresCol="features", predictionCol="prediction", weightCol="weight")
            m = km.fit(vectors)
            return m.summary.trainingCost, s, [list(map(float, c)) for c in m.clusterCenters()]

        try:
            workers = max(1, min(self.getOrDefault("parallelism"), len(seeds)))
            if workers == 1:
                results = [fit_one(s) for s in seeds]
            else:
                with ThreadPoolExecutor(max_workers=workers) as pool:
                    results = list(pool.map(fit_one, seeds))
        finally:
            vectors.unpersist()
        best = min(results, key=lambda t: (t[0], seeds.index(t[1])))
        return best[2]


def _abs_tolerance(tol: float, stats_row, lows, highs) -> float:
    """``tol * mean variance of the scaled features``: the summed squared centre shift that counts as converged.

    (For MLlib, which stops when every centre moved less than ``eps``,
    ``eps = sqrt(tol_abs / k)`` guarantees the summed rule.)
    """
    variances = []
    for c, lo, hi in zip(RFM_INPUTS, lows, highs):
        v = stats_row[f"var_{c}"] or 0.0
        rng = (hi - lo) if (hi is not None and lo is not None) else 0.0
        variances.append(v / (rng * rng) if rng else 0.0)
    return tol * sum(variances) / len(variances)


def _complete(cols) -> Column:
    cond = None
    for c in cols:
        e = F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        cond = e if cond is None else cond & e
    return cond


class _ModelWriter(MLWriter):
    """Writes a fitted model as one metadata file: its parameters and its fitted state (under 30 numbers)."""

    def __init__(self, instance: "RFMSegmenterModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        fitted = {"lows": [_number(x) for x in m.lows], "highs": [_number(x) for x in m.highs],
                  "centres": [[_number(x) for x in c] for c in m.centres],
                  "rankMap": [[int(k), int(v)] for k, v in sorted(m.rank_map.items())]}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"fitted": fitted})


class _ModelReader(MLReader):
    def load(self, path: str) -> "RFMSegmenterModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        if "fitted" not in metadata:
            raise ValueError(f"{path} holds no fitted segmenter model but a {metadata['class']}")
        fitted = metadata["fitted"]
        model = RFMSegmenterModel(lows=fitted["lows"], highs=fitted["highs"], centres=fitted["centres"],
                                  rank_map=dict(map(tuple, fitted["rankMap"])))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def _number(x):
    """A number as JSON keeps it exactly: whole numbers and doubles; null stays. Scoring reads bounds as doubles."""
    return x if x is None or isinstance(x, int) else float(x)


class RFMSegmenterModel(Model, _SegmenterParams, MLWritable, MLReadable):
    """Fitted state: min/max of the RFM inputs, centres and the cluster -> segment ranking.

    ``save(path)`` writes it wherever Spark writes; ``RFMSegmenterModel.load(path)`` scores as the saved model does, bit
    for bit. ``write().overwrite().save(path)`` replaces an earlier one.
    """

    def __init__(self, lows=None, highs=None, centres=None, rank_map=None):
        super().__init__()
        self.lows = lows
        self.highs = highs
        self.centres = centres
        self.rank_map = rank_map

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        feats = compute_rfm(dataset, self.getOrDefault("asOf"), self.getOrDefault("lastContactCol"))
        scored = _with_scores(feats, self.lows, self.highs)
        cluster = F.when(_complete(RFM_INPUTS), nearest_centre_expr(self.centres))
        out = apply_segments(scored.withColumn("cluster", cluster.cast("int")), self.rank_map)
        return add_priority_score(out)


def fit_transform(df: DataFrame, as_of, **params) -> DataFrame:
    """SEG11: fit on ``df`` and score it (row count preserved, input untouched).

    The input is checkpointed once, so its upstream plan (scans, aggregations,
    joins) runs once for both the fit and the scoring.
    """
    df = materialize(df)
    model = RFMSegmenter(asOf=str(as_of), **params).fit(df)
    return model.transform(df)


def segment_with_clusters(df: DataFrame, as_of, cluster_col: str = "cluster") -> DataFrame:
    """SEG1-SEG6 + SEG8-SEG10 with a given cluster column instead of a K-Means fit."""
    scored = normalize_rfm(materialize(compute_rfm(df, as_of)))
    if cluster_col != "cluster":
        scored = scored.withColumn("cluster", F.col(cluster_col).cast("int"))
    ranks = rank_clusters(scored)
    return add_priority_score(apply_segments(scored, ranks))

