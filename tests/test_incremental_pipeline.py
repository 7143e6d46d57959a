"""Incremental ingest (EXT4, batch and streaming), profiles (PRF1, PRF2 with F2) and the end-to-end run."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from accountlens.operators import quality as dq
from accountlens.operators import segmentation as seg
from accountlens.operators.profiles import segment_profile_report, segment_profiles
from accountlens.plans.batch import run_pipeline
from accountlens.streaming.incremental import append_new, new_rows, stream_ingest

SCHEMA = "interaction_id string, employer_id string, interaction_date date"


def batch(spark, ids):
    return spark.createDataFrame([(f"I{i}", "E1", dt.date(2025, 1, 1)) for i in ids], SCHEMA)


def test_new_rows(spark):
    out = new_rows(batch(spark, [2, 3, 3, 4]), batch(spark, [1, 2]))
    assert sorted(r[0] for r in out.select("interaction_id").collect()) == ["I3", "I4"]


def test_append_is_idempotent(spark, tmpdir_path):
    target = os.path.join(tmpdir_path, "fact")
    assert append_new(spark, batch(spark, [1, 2]), target) == 2
    assert append_new(spark, batch(spark, [2, 3]), target) == 1
    assert append_new(spark, batch(spark, [2, 3]), target) == 0
    assert spark.read.parquet(target).count() == 3


def test_stream_available_now(spark, tmpdir_path):
    src, target = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "fact")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    batch(spark, [1, 2]).write.mode("append").parquet(src)
    stream_ingest(spark, src, SCHEMA, target, ckpt)
    assert spark.read.parquet(target).count() == 2
    batch(spark, [2, 3]).write.mode("append").parquet(src)      # the same row delivered again + a new one
    stream_ingest(spark, src, SCHEMA, target, ckpt)
    stream_ingest(spark, src, SCHEMA, target, ckpt)              # re-run without new files: no change
    assert spark.read.parquet(target).count() == 3


@pytest.fixture(scope="module")
def segmented_df(spark):
    from test_segmentation import portfolio
    return seg.fit_transform(portfolio(spark, 90, dt.date(2025, 1, 1)), dt.date(2025, 1, 1), nInit=3)


def test_profile_report(segmented_df):
    p = segment_profile_report(segmented_df).toPandas()
    assert list(p.columns) == ["segment_name", "count", "avg_rfm_score", "avg_priority_score", "avg_revenue_potential"]
    assert len(p) <= 4 and p["count"].sum() == 90
    assert list(p["avg_rfm_score"]) == sorted(p["avg_rfm_score"], reverse=True)


def test_profiles_share_and_rounding(segmented_df):
    p = segment_profiles(segmented_df).toPandas()
    assert p["pct_of_total"].sum() == pytest.approx(100.0, abs=0.3)
    assert all(round(v, 1) == v for v in p["avg_recency_days"])


def test_profiles_need_segments(spark):
    with pytest.raises(ValueError):
        segment_profiles(spark.createDataFrame([(1,)], ["x"]))


def _write_raw(raw):
    """Both tables from row numbers and hashes of them."""
    spark = SparkSession.getActiveSession()
    os.makedirs(raw, exist_ok=True)

    def pick(name, values):
        options = F.array(*[F.lit(v) for v in values])
        return F.element_at(options, (F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(len(values))) + 1).cast("int"))

    def between(name, low, high):
        return (F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(high - low)) + low).cast("int")

    firms = spark.range(40).select(
        F.format_string("firm-%d", "id").alias("employer_id"), F.format_string("Firm no. %d", "id").alias("company_name"),
        pick("size", ["micro", "small", "medium", "large"]).alias("company_size"),
        pick("status", ["Active", "Inactive", "Prospect"]).alias("status"), pick("sector", ["tech", "retail"]).alias("sector"),
        (between("revenue", 100_000, 9_000_000) / 100).alias("revenue_potential"),
        F.date_sub(F.lit(dt.date(2025, 4, 17)), between("contact", 0, 500)).cast("string").alias("last_contact_date"),
        between("frequency", 0, 12).alias("frequency_12m"))
    talks = spark.range(120).select(
        F.format_string("talk-%d", "id").alias("interaction_id"),
        F.format_string("firm-%d", between("firm", 0, 40)).alias("employer_id"),
        F.date_sub(F.lit(dt.date(2025, 4, 17)), between("day", 0, 300)).cast("string").alias("interaction_date"),
        pick("type", ["call", "email"]).alias("interaction_type"), pick("outcome", ["positive", "neutral"]).alias("outcome"))
    firms.toPandas().to_csv(os.path.join(raw, "employers.csv"), index=False)
    talks.toPandas().to_csv(os.path.join(raw, "interactions.csv"), index=False)


def test_pipeline_end_to_end(spark, tmpdir_path):
    raw, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "processed")
    _write_raw(raw)
    res = run_pipeline(spark, raw, out, dt.date(2025, 6, 1), salt="fixed", run_date=dt.date(2025, 6, 1),
                       segmenter_params={"nInit": 3})
    seg_df = spark.read.parquet(res["segmented"])
    assert seg_df.count() == 40 and seg_df.filter("segment_name IS NULL").count() == 0
    assert seg_df.filter("company_name NOT LIKE 'anon_%'").count() == 0
    prof = spark.read.option("header", True).csv(res["profiles"])
    assert sum(int(r["count"]) for r in prof.collect()) == 40
    assert spark.read.option("header", True).csv(res["audit"]).count() == 2
    assert res["reports"]["employers"].passed


def test_pipeline_stops_on_bad_employers(spark, tmpdir_path):
    raw, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "processed")
    _write_raw(raw)
    df = pd.read_csv(os.path.join(raw, "employers.csv"))
    df.loc[0, "last_contact_date"] = "2099-01-01"
    df.to_csv(os.path.join(raw, "employers.csv"), index=False)
    with pytest.raises(dq.DataQualityError):
        run_pipeline(spark, raw, out, dt.date(2025, 6, 1), salt="fixed", segmenter_params={"nInit": 2})


def test_pipeline_flags(spark, tmpdir_path):
    raw, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "processed")
    _write_raw(raw)
    inter = pd.read_csv(os.path.join(raw, "interactions.csv"))
    inter.loc[0, "interaction_type"] = None                   # contract passes, quality check fails (null invalid)
    inter.to_csv(os.path.join(raw, "interactions.csv"), index=False)
    params = {"nInit": 2}
    res = run_pipeline(spark, raw, out, dt.date(2025, 6, 1), salt="fixed", segmenter_params=params, drop_pii=True,
                       output_format="csv", run_date=dt.date(2025, 6, 2))
    assert res["reports"]["interactions"].passed is False            # warns, continues
    assert "company_name" not in spark.read.option("header", True).csv(res["segmented"]).columns
    with pytest.raises(dq.DataQualityError):
        run_pipeline(spark, raw, out, dt.date(2025, 6, 1), salt="fixed", segmenter_params=params,
                     strict_interactions=True)
    skipped = run_pipeline(spark, raw, out, dt.date(2025, 6, 1), salt="fixed", segmenter_params=params,
                           skip_validation=True)
    assert skipped["reports"] == {}


def test_stream_csv_source(spark, tmpdir_path):
    src, target = os.path.join(tmpdir_path, "csv_in"), os.path.join(tmpdir_path, "fact_csv")
    batch(spark, [1, 2, 3]).write.mode("append").option("header", True).csv(src)
    stream_ingest(spark, src, SCHEMA, target, os.path.join(tmpdir_path, "ckpt_csv"), fmt="csv")
    batch(spark, [3, 4]).write.mode("append").option("header", True).csv(src)
    stream_ingest(spark, src, SCHEMA, target, os.path.join(tmpdir_path, "ckpt_csv"), fmt="csv")
    ids = sorted(r[0] for r in spark.read.parquet(target).select("interaction_id").collect())
    assert ids == ["I1", "I2", "I3", "I4"]
