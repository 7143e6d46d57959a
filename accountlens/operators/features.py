"""Contact features derived from the interaction fact table (AGG1-2, FLT1, JOIN1-2, FIL1).

One shuffle: ``groupBy(employer_id)`` with a map-side partial aggregate, so a
hot employer (even a third of all interactions) collapses to one row per input
partition before the exchange. The result has one row per employer, so the
join back to the employer table is skew-free; AQE turns it into a broadcast
join at run time only when the measured size is under the broadcast threshold.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens import constants as C
from accountlens.functions.expressions import as_date_lit


def filter_since(df: DataFrame, column: str, cutoff) -> DataFrame:
    """FLT1: keep rows with ``column >= cutoff`` (a plain comparison, pushed to the scan)."""
    return df.filter(F.col(column) >= as_date_lit(cutoff))


def last_contact(interactions: DataFrame, employer_col: str = "employer_id",
                 date_col: str = "interaction_date") -> DataFrame:
    """AGG1: latest interaction date per employer."""
    return interactions.groupBy(employer_col).agg(F.max(date_col).alias("last_contact_date"))


def frequency(interactions: DataFrame, as_of, window_days: int = C.FREQUENCY_WINDOW_DAYS,
              employer_col: str = "employer_id", date_col: str = "interaction_date") -> DataFrame:
    """AGG2: interactions on or after ``as_of - window_days`` per employer (employers without any are absent)."""
    recent = filter_since(interactions, date_col, _cutoff(as_of, window_days))
    return recent.groupBy(employer_col).agg(F.count(F.lit(1)).cast("long").alias("frequency_12m"))


def _cutoff(as_of, days: int) -> Column:
    if isinstance(as_of, (str, _dt.date)):
        d = _dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
        if isinstance(d, _dt.datetime):
            d = d.date()
        return F.lit(d - _dt.timedelta(days=days))
    return F.date_sub(as_of, days)


def contact_features(interactions: DataFrame, as_of, window_days: int = C.FREQUENCY_WINDOW_DAYS,
                     employer_col: str = "employer_id", date_col: str = "interaction_date") -> DataFrame:
    """AGG1 + AGG2 fused in a single aggregation (one shuffle instead of two)."""
    d = F.col(date_col)
    return interactions.groupBy(employer_col).agg(
        F.max(d).alias("last_contact_date"),
        F.count_if(d >= _cutoff(as_of, window_days)).cast("long").alias("frequency_12m"),
    )


def enrich_employers(employers: DataFrame, features: DataFrame, employer_col: str = "employer_id") -> DataFrame:
    """JOIN1 + JOIN2 + FIL1: left join the features, employers without contacts get frequency 0."""
    base = employers.drop(*[c for c in ("last_contact_date", "frequency_12m") if c in employers.columns])
    joined = base.join(features, on=employer_col, how="left")
    if "frequency_12m" in features.columns:
        joined = joined.withColumn("frequency_12m", F.coalesce(F.col("frequency_12m"), F.lit(0)).cast("long"))
    return joined
