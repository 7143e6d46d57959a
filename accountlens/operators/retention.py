"""Retention rules and row-level security (EXT1, EXT2, EXT5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountlens import constants as C
from accountlens.functions.expressions import as_date_lit
from accountlens.operators.features import last_contact


def retain_employers(employers: DataFrame, interactions: DataFrame, as_of,
                     months: int = C.EMPLOYER_RETENTION_MONTHS) -> DataFrame:
    """EXT1: keep employers whose last interaction is at most ``months`` before as_of.

    Employers never contacted are kept and flagged (``never_contacted``) for review.
    """
    last = last_contact(interactions).withColumnRenamed("last_contact_date", "__last")
    cutoff = F.add_months(as_date_lit(as_of), -months)
    base = employers.drop("never_contacted")
    joined = base.join(last, "employer_id", "left")
    kept = joined.filter(F.col("__last").isNull() | (F.col("__last").cast("date") >= cutoff))
    return kept.withColumn("never_contacted", F.col("__last").isNull()).drop("__last")


def retain_interactions(interactions: DataFrame, as_of, months: int = C.INTERACTION_RETENTION_MONTHS,
                        date_col: str = "interaction_date") -> DataFrame:
    """EXT2: keep interactions of the last ``months`` (cut-off inclusive; pushed to the scan)."""
    return interactions.filter(F.col(date_col) >= F.add_months(as_date_lit(as_of), -months))


def consultant_access(interactions: DataFrame) -> DataFrame:
    """EXT5 mapping: distinct (consultant_id, employer_id) pairs a consultant has worked with."""
    return interactions.select("consultant_id", "employer_id").filter(
        F.col("consultant_id").isNotNull() & F.col("employer_id").isNotNull()).distinct()


def visible_employers(employers: DataFrame, interactions: DataFrame, consultant_id: str | None = None) -> DataFrame:
    """EXT5: employers a consultant may see (own accounts only).

    With ``consultant_id`` a semi join on that consultant's accounts; without it
    the full (consultant_id, employer columns) view for every consultant.
    """
    access = consultant_access(interactions)
    if consultant_id is not None:
        mine = access.filter(F.col("consultant_id") == consultant_id).select("employer_id")
        return employers.join(mine, "employer_id", "left_semi")
    return access.join(employers, "employer_id", "inner")
