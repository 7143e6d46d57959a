"""One key holding a third of all rows: results stay whole and exact (pre-aggregation before shuffles/joins)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from accountlens.operators import measures as ms
from accountlens.operators import quality as dq
from accountlens.operators.features import contact_features, enrich_employers
from accountlens.streaming.incremental import new_rows

D = dt.date(2025, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 interactions; employer E0 holds 1,000 of them."""
    base = spark.range(3000).select(
        F.col("id").cast("string").alias("interaction_id"),
        F.when(F.col("id") < 1000, F.lit("E0")).otherwise(F.concat(F.lit("E"), (F.col("id") % 200 + 1).cast("string")))
        .alias("employer_id"),
        F.date_sub(F.lit(D), (F.col("id") % 500).cast("int")).alias("interaction_date"))
    employers = spark.range(201).select(F.concat(F.lit("E"), F.col("id").cast("string")).alias("employer_id"),
                                        F.lit("Active").alias("status"))
    return base.repartition(8), employers


def test_contact_features_hot_key(skewed):
    inter, emp = skewed
    feats = {r["employer_id"]: r for r in contact_features(inter, D).collect()}
    exp = inter.filter("employer_id = 'E0' AND interaction_date >= date_sub(DATE'2025-01-01', 365)").count()
    assert feats["E0"]["frequency_12m"] == exp
    assert enrich_employers(emp, contact_features(inter, D)).count() == 201


def test_churn_and_glossary_hot_key(skewed):
    inter, emp = skewed
    scores = {r["employer_id"]: r for r in ms.churn_risk(emp, inter, D).collect()}
    assert len(scores) == 201 and scores["E0"]["days_since_contact"] == 0
    assert ms.active_employers_glossary(emp, inter, D).count() == 201


def test_ref_integrity_hot_orphan(spark, skewed):
    inter, emp = skewed
    orphaned = inter.withColumn("employer_id", F.when(F.col("employer_id") == "E0", "X0").otherwise(F.col("employer_id")))
    rep = dq.ValidationReport.collect(dq.validate(orphaned, (dq.ref_integrity("employer_id"),), "I", D,
                                                  parent=emp, parent_key="employer_id"))
    assert rep.results[0]["affected_rows"] == 1000


def test_daily_fact_hot_key(skewed):
    inter, emp = skewed
    daily = ms.daily_fact(inter, emp.withColumn("seg", F.lit("a")), by=["seg"])
    assert daily.agg(F.sum("interactions")).first()[0] == 3000


def test_redelivered_copies(spark, skewed):
    inter, _ = skewed
    copies = inter.filter("interaction_id = '7'")
    for _ in range(10):
        copies = copies.unionByName(copies)           # 1,024 copies of one row
    batch = inter.filter("CAST(interaction_id AS INT) >= 2500").unionByName(copies)
    out = new_rows(batch, inter.filter("CAST(interaction_id AS INT) < 2000"))
    assert out.count() == 500
