"""Segmentation (SEG1-SEG12): properties of the result on a generated portfolio, and edge cases."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from accountlens import constants as C
from accountlens.operators import segmentation as seg
from accountlens.operators.profiles import segment_profiles

from conftest import AS_OF

FAST = dict(nInit=3)


def portfolio(spark, n: int, as_of: dt.date):
    """n employers whose attributes are hashes of their number: no two runs or engines differ."""
    draw = lambda salt, size: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(size)).cast("int")
    pick = lambda salt, names: F.element_at(F.array(*map(F.lit, names)), draw(salt, len(names)) + 1)
    return spark.range(n).select(
        F.format_string("E-%06d", "id").alias("employer_id"),
        F.date_format(F.date_sub(F.lit(as_of), draw("age", 650) + 5), "yyyy-MM-dd").alias("last_contact_date"),
        draw("visits", 25).cast("long").alias("frequency_12m"),
        (F.lit(2_500.0) + draw("money", 150_000)).alias("revenue_potential"),
        pick("size", ("micro", "small", "medium", "large")).alias("company_size"),
        pick("sector", ("food", "energy", "transport")).alias("sector"),
        pick("status", ("Active", "Prospect", "Inactive")).alias("status"))


@pytest.fixture(scope="module")
def sample_employers(spark):
    return portfolio(spark, 130, AS_OF).cache()


@pytest.fixture(scope="module")
def segmented(sample_employers):
    return seg.fit_transform(sample_employers, AS_OF, **FAST).toPandas()


def test_every_employer_is_segmented_once_with_scores_in_range(sample_employers, segmented):
    names = {s[1] for s in C.SEGMENTS}
    ids = [r["employer_id"] for r in sample_employers.select("employer_id").collect()]
    assert sorted(segmented["employer_id"]) == sorted(ids)
    added = {"recency_days", "r_score", "f_score", "m_score", "rfm_score", "cluster", "segment_id", "segment_name",
             "segment_priority", "segment_action", "priority_score"}
    assert added <= set(segmented.columns)
    for row in segmented.itertuples():
        assert row.segment_name in names and 0 <= row.rfm_score <= 1 and 0 <= row.priority_score <= 100


def test_profiles_cover_the_portfolio(spark, segmented):
    rows = segment_profiles(spark.createDataFrame(segmented)).collect()
    priorities = [r["avg_priority_score"] for r in rows]
    assert 1 <= len(rows) <= len(C.SEGMENTS) and priorities == sorted(priorities)[::-1]
    assert sum(r["count"] for r in rows) == 130


def test_segments_do_not_depend_on_the_partitioning(sample_employers):
    pairs = [{(r["employer_id"], r["segment_name"]) for r in
              seg.fit_transform(df, AS_OF, **FAST).select("employer_id", "segment_name").collect()}
             for df in (sample_employers, sample_employers.repartition(6))]
    assert pairs[0] == pairs[1]


def test_longer_silence_means_higher_priority(segmented):
    quiet = segmented["recency_days"] > segmented["recency_days"].median()
    assert segmented.loc[quiet, "priority_score"].mean() > segmented.loc[~quiet, "priority_score"].mean()


def test_segment_ranking_follows_mean_rfm(segmented):
    means = segmented.groupby("segment_id")["rfm_score"].mean().sort_index()
    assert list(means) == sorted(means, reverse=True)


def test_batched_solver_matches_quality(sample_employers):
    m1 = seg.RFMSegmenter(asOf=str(AS_OF), nInit=4, solver="batched").fit(sample_employers)
    m2 = seg.RFMSegmenter(asOf=str(AS_OF), nInit=4, solver="mllib").fit(sample_employers)
    out1 = m1.transform(sample_employers).toPandas()
    out2 = m2.transform(sample_employers).toPandas()

    def cost(out, centres):
        c = np.array(centres)[out["cluster"].to_numpy()]
        x = out[["r_score", "f_score", "m_score"]].to_numpy()
        return float(((x - c) ** 2).sum())
    assert cost(out1, m1.centres) <= cost(out2, m2.centres) * 1.05


# --- edge cases -------------------------------------------------------------

def _frame(spark, rows, cols=("employer_id", "last_contact_date", "frequency_12m", "revenue_potential")):
    return spark.createDataFrame(rows, list(cols))


def test_recency_floor_with_time_of_day_and_future(spark):
    df = spark.createDataFrame([("a", dt.datetime(2025, 5, 31, 18, 0)), ("b", dt.datetime(2025, 6, 1, 0, 0)),
                                ("c", dt.datetime(2025, 6, 1, 6, 0)), ("d", dt.datetime(2025, 6, 3, 0, 0))],
                               ["employer_id", "last_contact_date"])
    out = dict(seg.compute_rfm(df.withColumn("frequency_12m", F.lit(1)).withColumn("revenue_potential", F.lit(1.0)),
                               AS_OF).select("employer_id", "recency_days").collect())
    assert out == {"a": 0, "b": 0, "c": -1, "d": -2}


def test_recency_text_dates_and_malformed_raises(spark):
    df = _frame(spark, [("a", "2025-05-01", 1, 1.0), ("b", "not a date", 1, 1.0)])
    with pytest.raises(Exception):
        seg.compute_rfm(df, AS_OF).collect()


def test_constant_columns_scale_to_zero(spark):
    df = _frame(spark, [(f"e{i}", "2025-05-01", 3, 100.0) for i in range(6)])
    out = seg.normalize_rfm(seg.compute_rfm(df, AS_OF)).select("r_score", "f_score", "m_score").distinct().collect()
    assert [tuple(r) for r in out] == [(1.0, 0.0, 0.0)]


def test_rounding_expression_matches_numpy(spark):
    vals = [0.125, 0.375, 2.675, 1.005, 0.5, 1.5, 2.5, -0.125, 12.34567]
    df = spark.createDataFrame([(v,) for v in vals], ["x"])
    got = [r[0] for r in df.select(seg.round_half_even(F.col("x"), 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]
    got0 = [r[0] for r in df.select(seg.round_half_even(F.col("x"), 0)).collect()]
    assert got0 == [float(np.round(v, 0)) for v in vals]


def test_priority_keeps_null(spark):
    df = spark.createDataFrame([(None, 0.5, 0.5)], "recency_days long, rfm_score double, f_score double")
    assert df.select(seg.priority_score_expr(F.col("rfm_score"), F.col("recency_days"), F.col("f_score"))).first()[0] is None


def test_priority_score_formula(spark):
    df = spark.createDataFrame([(730, 0.2, 0.1), (0, 1.0, 1.0), (100, 0.5, 0.25)],
                               "recency_days long, rfm_score double, f_score double")
    got = [r[0] for r in df.select(seg.priority_score_expr(F.col("rfm_score"), F.col("recency_days"),
                                                           F.col("f_score"))).collect()]
    exp = [np.round(np.clip(0.5 * (1 - r) + 0.3 * np.clip(d / 365, 0, 1) + 0.2 * (1 - f), 0, 1) * 100, 1)
           for d, r, f in [(730, 0.2, 0.1), (0, 1.0, 1.0), (100, 0.5, 0.25)]]
    assert got == exp


def test_null_policy(spark):
    rows = [(f"e{i}", f"2025-0{1 + i % 5}-0{1 + i % 7}", i, 1000.0 * (i + 1)) for i in range(12)] + [("z", None, 1, 5.0)]
    df = _frame(spark, rows)
    with pytest.raises(ValueError, match="null"):
        seg.fit_transform(df, AS_OF, **FAST)
    out = seg.fit_transform(df, AS_OF, nullPolicy="keep", **FAST).toPandas()
    assert len(out) == 13
    z = out[out.employer_id == "z"].iloc[0]
    assert pd.isna(z["segment_name"]) and pd.isna(z["priority_score"])


def test_fewer_rows_than_k_raises(spark):
    df = _frame(spark, [("a", "2025-05-01", 1, 10.0), ("b", "2025-04-01", 2, 20.0)])
    with pytest.raises(ValueError):
        seg.fit_transform(df, AS_OF, **FAST)


def test_k_out_of_range(spark):
    df = _frame(spark, [(f"e{i}", "2025-05-01", i, 10.0 * i) for i in range(10)])
    with pytest.raises(ValueError):
        seg.fit_transform(df, AS_OF, nSegments=5)
    with pytest.raises(ValueError):
        seg.fit_transform(df, AS_OF, nSegments=0)


def test_k_equal_one(spark):
    df = _frame(spark, [(f"e{i}", "2025-05-01", i, 10.0 * i) for i in range(10)])
    out = seg.fit_transform(df, AS_OF, nSegments=1).toPandas()
    assert set(out["segment_name"]) == {"Champions"} and set(out["cluster"]) == {0}


def test_fewer_distinct_points_than_k(spark):
    rows = [(f"e{i}", "2025-05-01" if i % 2 else "2024-01-01", i % 2, 10.0 if i % 2 else 99.0) for i in range(12)]
    out = seg.fit_transform(_frame(spark, rows), AS_OF, **FAST).toPandas()
    assert out["segment_name"].notna().all()
    assert out.groupby("employer_id").size().max() == 1


def test_frequency_and_revenue_fallbacks(spark):
    # F3 (a): no frequency_12m and no revenue_potential, total_interactions given
    rng = np.random.default_rng(0)
    n = 60
    pdf = pd.DataFrame({"employer_id": [f"E{i}" for i in range(n)],
                        "last_contact_date": [(AS_OF - dt.timedelta(days=int(d))).isoformat() for d in rng.integers(1, 400, n)],
                        "total_interactions": rng.integers(1, 15, n).astype("int64"),
                        "company_size": rng.choice(["small", "medium", "large"], n),
                        "sector": rng.choice(["tech", "retail"], n)})
    out = seg.fit_transform(spark.createDataFrame(pdf), AS_OF, **FAST).toPandas()
    assert (out["frequency_12m"] == pdf["total_interactions"]).all()
    base = {"micro": 5000, "small": 20000, "medium": 75000, "large": 200000}
    mult = {"tech": 1.4, "retail": 0.9}
    exp = np.round(pdf["company_size"].map(base) * pdf["sector"].map(mult), 0)
    assert np.allclose(out.sort_values("employer_id")["revenue_potential"].to_numpy(),
                       exp[pdf.sort_values("employer_id").index].to_numpy())
    # F3 (b): no revenue_potential, frequency present; constant 1 without either count column
    pdf2 = pdf.drop(columns=["total_interactions"])
    out2 = seg.compute_rfm(spark.createDataFrame(pdf2), AS_OF).select("frequency_12m").distinct().collect()
    assert [r[0] for r in out2] == [1]


def test_revenue_fallback_needs_both_columns(spark):
    df = spark.createDataFrame([("a", "2025-05-01", 1, "small")], ["employer_id", "last_contact_date", "frequency_12m",
                                                                    "company_size"])
    with pytest.raises(ValueError):
        seg.compute_rfm(df, AS_OF)


def test_unknown_size_and_sector_defaults(spark):
    df = spark.createDataFrame([("a", "giant", "finance"), ("b", None, None)], ["employer_id", "company_size", "sector"])
    vals = [r[0] for r in df.select(seg.estimate_revenue_potential(df)).collect()]
    assert vals == [20000.0, 20000.0]


def test_model_transform_is_one_narrow_pass(spark, sample_employers):
    model = seg.RFMSegmenter(asOf=str(AS_OF), **FAST).fit(sample_employers)
    plan = model.transform(sample_employers)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_segment_sizes(segmented, spark):
    sizes = seg.segment_sizes(spark.createDataFrame(segmented)).toPandas()
    assert sizes["count"].sum() == len(segmented)


def test_hot_copies_collapse_to_one_weighted_point(spark):
    """A third of the rows are copies of one row: they become one weighted point, results stay whole."""
    rows = [(f"e{i}", f"2025-0{1 + i % 5}-{10 + i % 17}", i % 9, 1000.0 * (i + 1)) for i in range(40)]
    rows += [("hot", "2024-12-01", 2, 5000.0)] * 20
    df = _frame(spark, rows)
    est = seg.RFMSegmenter(asOf=str(AS_OF), **FAST)
    feats = seg.normalize_rfm(seg.compute_rfm(df, AS_OF))
    pts = est._weighted_points(feats, 60).collect()
    assert len(pts) == 41 and max(p["weight"] for p in pts) == 20.0
    out = est.fit(df).transform(df).toPandas()
    assert len(out) == 60 and out["segment_name"].notna().all()
    assert out[out.employer_id == "hot"]["segment_name"].nunique() == 1


def _numpy_kmeans(X, k, seed, iters=300):
    """Brute-force reference: k-means++ seeding + Lloyd, in NumPy."""
    rng = np.random.default_rng(seed)
    C = [X[rng.integers(len(X))]]
    for _ in range(1, k):
        d = np.min(((X[:, None, :] - np.array(C)[None]) ** 2).sum(-1), axis=1)
        C.append(X[rng.choice(len(X), p=d / d.sum())])
    C = np.array(C)
    for _ in range(iters):
        lab = np.argmin(((X[:, None, :] - C[None]) ** 2).sum(-1), axis=1)
        new = np.array([X[lab == j].mean(axis=0) if np.any(lab == j) else C[j] for j in range(k)])
        if np.allclose(new, C):
            break
        C = new
    return float(np.min(((X[:, None, :] - C[None]) ** 2).sum(-1), axis=1).sum())


@pytest.mark.parametrize("solver", ["batched", "mllib"])
def test_kmeans_cost_matches_brute_force(sample_employers, solver):
    model = seg.RFMSegmenter(asOf=str(AS_OF), solver=solver).fit(sample_employers)   # default 20 restarts
    out = model.transform(sample_employers).toPandas()
    X = out[["r_score", "f_score", "m_score"]].to_numpy()
    cost = float(((X - np.array(model.centres)[out["cluster"].to_numpy()]) ** 2).sum())
    best = min(_numpy_kmeans(X, 4, s) for s in range(50))
    assert cost <= best * 1.02


def test_repeated_fits_are_equal_bit_for_bit(sample_employers):
    fits = [seg.RFMSegmenter(asOf=str(AS_OF), nInit=5, rowsPerPartition=n).fit(sample_employers.repartition(p))
            for n, p in ((50_000, 1), (50_000, 7))]
    assert fits[0].centres == fits[1].centres and fits[0].rank_map == fits[1].rank_map


def test_given_starting_centres(spark, sample_employers):
    start = [[0.2, 0.1, 0.2], [0.9, 0.1, 0.2], [0.9, 0.4, 0.8], [0.6, 0.6, 0.4]]
    model = seg.RFMSegmenter(asOf=str(AS_OF), startCentres=start, maxIter=3, tol=0.0).fit(sample_employers)
    scored = seg.normalize_rfm(seg.compute_rfm(sample_employers, AS_OF)).toPandas()
    X, centres = scored[seg.SCORE_COLS].to_numpy(), np.array(start)
    for _ in range(3):
        near = np.argmin(((X[:, None, :] - centres[None]) ** 2).sum(-1), axis=1)
        centres = np.array([X[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(4)])
    assert np.allclose(model.centres, centres, atol=1e-9)
    for bad in (dict(startCentres=start[:3]), dict(startCentres=[[0.0]] * 4), dict(startCentres=start, solver="mllib")):
        with pytest.raises(ValueError):
            seg.RFMSegmenter(asOf=str(AS_OF), **bad).fit(sample_employers)


def test_fit_from_another_working_directory(tmp_path):
    """Python workers do not need the package on their path (the solver's code is shipped by value)."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "spark.sparkContext.setCheckpointDir(%r)\n"
        "from accountlens.operators.segmentation import fit_transform\n"
        "df = spark.createDataFrame([(f'e{i}', f'2025-0{1 + i %% 5}-1{i %% 9}', i %% 7, 100.0 * i) for i in range(30)],\n"
        "                           ['employer_id', 'last_contact_date', 'frequency_12m', 'revenue_potential'])\n"
        "print('ROWS', fit_transform(df, '2025-06-01', nInit=2).count())\n"
    ) % (repo, str(tmp_path / "ckpt"))
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True, text=True, timeout=600)
    assert "ROWS 30" in out.stdout, out.stderr[-2000:]


def test_saved_model_scores_like_the_fitted_one(sample_employers, tmp_path):
    estimator = seg.RFMSegmenter(asOf=str(AS_OF), nInit=3, nSegments=3)
    estimator.save(str(tmp_path / "estimator"))
    again = seg.RFMSegmenter.load(str(tmp_path / "estimator"))
    assert again.uid == estimator.uid and again.extractParamMap() == estimator.extractParamMap()
    model = again.fit(sample_employers)
    path = str(tmp_path / "model")
    model.save(path)
    loaded = seg.RFMSegmenterModel.load(path)
    assert (loaded.uid, loaded.lows, loaded.highs, loaded.centres, loaded.rank_map) == (
        model.uid, model.lows, model.highs, model.centres, model.rank_map)
    assert loaded.getOrDefault("nSegments") == 3 and loaded.getOrDefault("asOf") == str(AS_OF)
    assert sorted(map(tuple, loaded.transform(sample_employers).collect())) == sorted(map(tuple, model.transform(sample_employers).collect()))
    with pytest.raises(Exception, match="already exists"):
        model.save(path)
    model.write().overwrite().save(path)
    with pytest.raises(ValueError, match="no fitted segmenter model"):
        seg.RFMSegmenterModel.load(str(tmp_path / "estimator"))
    with pytest.raises(Exception):
        seg.RFMSegmenterModel.load(str(tmp_path / "nowhere"))
