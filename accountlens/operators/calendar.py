"""Calendar dimension and period helpers (DIM1, M14, M15).

Every time-intelligence measure first aggregates the fact table to one row
per (group, day) or (group, month), then densifies on the calendar; windows
only ever run on those aggregated rows, never on raw facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountlens.functions.expressions import in_months_window  # noqa: F401  (M14, re-exported)


def date_dimension(fact: DataFrame, date_col: str = "interaction_date", start=None, end=None) -> DataFrame:
    """DIM1: one row per day between the first and last fact date (or the given bounds)."""
    bounds = fact.agg(F.min(F.col(date_col).cast("date")).alias("lo"), F.max(F.col(date_col).cast("date")).alias("hi"))
    if start is not None:
        bounds = bounds.withColumn("lo", F.lit(start).cast("date"))
    if end is not None:
        bounds = bounds.withColumn("hi", F.lit(end).cast("date"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.trunc("date", "month").alias("month_start"),
        F.last_day("date").alias("month_end"),
        F.dayofweek("date").alias("day_of_week"),
    )


def month_bounds(fact: DataFrame, date_col: str = "interaction_date"):
    """First and last fact month (one aggregated row to the driver)."""
    row = fact.agg(F.trunc(F.min(F.col(date_col).cast("date")), "month").alias("lo"),
                   F.trunc(F.max(F.col(date_col).cast("date")), "month").alias("hi")).first()
    return row["lo"], row["hi"]


def _month_seq(lo, hi) -> Column:
    return F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 1 MONTH")))


def month_dimension(fact: DataFrame, date_col: str = "interaction_date") -> DataFrame:
    """Dense months between the first and last fact month."""
    bounds = fact.agg(F.trunc(F.min(F.col(date_col).cast("date")), "month").alias("lo"),
                      F.trunc(F.max(F.col(date_col).cast("date")), "month").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))


def null_safe_join(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Equi-join in which null keys match each other; the key columns are those of ``left``."""
    on = list(on)
    renamed = right.withColumnsRenamed({c: f"__right_{c}" for c in on})
    condition = None
    for c in on:
        same = left[c].eqNullSafe(renamed[f"__right_{c}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"__right_{c}" for c in on])


def monthly_counts(fact: DataFrame, date_col: str = "interaction_date", by=(), dense: bool = True,
                   weight: str | None = None) -> DataFrame:
    """Interactions per (group, month), densified over the global month range: empty months get 0.

    The grid is generated per group with ``sequence`` over literal bounds (no join
    with a month table); counts are pre-aggregated before the join back. With a
    high-cardinality grouping (e.g. per employer) ``dense=False`` keeps only the
    months that have facts: every measure built on it gives the same values for
    those rows (``previous_month`` checks month adjacency itself). A null group is a group like
    any other. ``weight`` names a column of counts in a fact that is aggregated already.
    """
    by = list(by)
    counts = (fact.groupBy(*by, F.trunc(F.col(date_col).cast("date"), "month").alias("month_start"))
              .agg((F.sum(weight) if weight else F.count(F.lit(1))).cast("long").alias("interactions")))
    if not dense:
        return counts
    # bounds and groups come from the (small) monthly aggregate, not from the fact
    if not by:
        grid = month_dimension(counts, "month_start")
    else:
        lo, hi = month_bounds(counts, "month_start")
        if lo is None:
            return counts
        grid = counts.select(*by).distinct().select(*by, _month_seq(lo, hi).alias("month_start"))
    empty = grid.withColumn("interactions", F.lit(0).cast("long"))
    return counts.unionByName(empty).groupBy(*by, "month_start").agg(F.sum("interactions").alias("interactions"))


def previous_month(counts: DataFrame, value_col: str = "interactions", by=(), out_col: str = "previous_month") -> DataFrame:
    """M15: the value of the same group one month back (over dense months), null for the first month."""
    w = Window.partitionBy(*by).orderBy("month_start") if by else Window.partitionBy(F.lit(0)).orderBy("month_start")
    prev_month = F.lag("month_start", 1).over(w)
    prev_val = F.lag(value_col, 1).over(w)
    return counts.withColumn(out_col, F.when(prev_month == F.add_months(F.col("month_start"), -1), prev_val))
