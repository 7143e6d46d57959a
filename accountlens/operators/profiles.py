"""Segment profiles (PRF1, PRF2): one aggregation over the segmented table, at most 4 rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accountlens.functions.expressions import round_half_even


def segment_profiles(df: DataFrame) -> DataFrame:
    """PRF1: per segment count, mean recency / frequency / revenue / priority and share of all rows.

    Rounded to 1 digit, sorted by avg_priority_score descending. Rows without a
    segment are left out of the groups but stay in the share's denominator.
    """
    if "segment_name" not in df.columns:
        raise ValueError("segment_name missing: run the segmenter first")
    per = df.groupBy("segment_name").agg(
        F.count("employer_id").cast("long").alias("count"),
        F.count(F.lit(1)).alias("__rows"),
        F.avg("recency_days").alias("avg_recency_days"),
        F.avg("frequency_12m").alias("avg_frequency"),
        F.avg("revenue_potential").alias("avg_revenue_potential"),
        F.avg("priority_score").alias("avg_priority_score"),
    )
    # the window runs over the (<= 5) aggregated rows only
    total = F.sum("__rows").over(Window.partitionBy(F.lit(1)))
    out = per.withColumn("pct_of_total", F.col("__rows") / total * F.lit(100.0)).filter(F.col("segment_name").isNotNull())
    rounded = [round_half_even(F.col(c), 1).alias(c) for c in
               ("avg_recency_days", "avg_frequency", "avg_revenue_potential", "avg_priority_score", "pct_of_total")]
    return (out.select("segment_name", "count", *rounded)
            .orderBy(F.col("avg_priority_score").desc_nulls_last()))


def segment_profile_report(df: DataFrame) -> DataFrame:
    """PRF2: per segment count, mean rfm / priority / revenue, rounded to 2, sorted by avg_rfm_score desc."""
    per = df.groupBy("segment_name").agg(
        F.count("employer_id").cast("long").alias("count"),
        round_half_even(F.avg("rfm_score"), 2).alias("avg_rfm_score"),
        round_half_even(F.avg("priority_score"), 2).alias("avg_priority_score"),
        round_half_even(F.avg("revenue_potential"), 2).alias("avg_revenue_potential"),
    ).filter(F.col("segment_name").isNotNull())
    return per.orderBy(F.col("avg_rfm_score").desc_nulls_last())
