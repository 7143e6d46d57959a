"""Star schema (DIM2-DIM5) over the segmented employer table and the interaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountlens import constants as C

DIM_EMPLOYER_COLUMNS = ["employer_id", "sector", "company_size", "region", "status", "revenue_potential",
                        "segment_name", "priority_score", "rfm_score"]
FACT_COLUMNS = {"interaction_id": "string", "employer_id": "string", "consultant_id": "string",
                "interaction_date": "date", "interaction_type": "string", "outcome": "string",
                "follow_up_required": "boolean"}


def segment_dimension_expr_rows():
    """The fixed segment rows (segment_id, segment_name, priority, color_hex, recommended_action)."""
    return [(s[0], s[1], s[3], s[2], s[4]) for s in C.SEGMENTS]


def segment_dimension(segmented: DataFrame) -> DataFrame:
    """DIM2: segment attributes for the segment ids present in ``segmented``.

    Attributes come from the fixed segment table as literal lookups, so no
    join is needed; ``segment_id`` values outside the table yield nulls.
    """
    ids = segmented.select(F.col("segment_id").cast("int").alias("segment_id")).filter("segment_id IS NOT NULL").distinct()
    rows = segment_dimension_expr_rows()

    def lookup(pos, typ):
        m = F.create_map(*[x for r in rows for x in (F.lit(r[0]), F.lit(r[pos]))])
        return F.try_element_at(m, F.col("segment_id")).cast(typ)

    return ids.select("segment_id", lookup(1, "string").alias("segment_name"), lookup(2, "int").alias("priority"),
                      lookup(3, "string").alias("color_hex"), lookup(4, "string").alias("recommended_action"))


def employer_dimension(segmented: DataFrame) -> DataFrame:
    """DIM3: the documented employer dimension columns (those present)."""
    return segmented.select(*[c for c in DIM_EMPLOYER_COLUMNS if c in segmented.columns])


def interaction_fact(interactions: DataFrame) -> DataFrame:
    """DIM4: the fact table's documented columns with their types."""
    cols = []
    for name, typ in FACT_COLUMNS.items():
        if name not in interactions.columns:
            continue
        c = F.col(name)
        if typ == "date":
            c = F.to_date(c)
        elif typ == "boolean":
            c = c.cast("boolean")
        else:
            c = c.cast(typ)
        cols.append(c.alias(name))
    return interactions.select(*cols)


#: Segment attributes by segment name (position in a row of ``segment_dimension_expr_rows``, type).
SEGMENT_ATTRS = {"segment_id": (0, "int"), "priority": (2, "int"), "color_hex": (3, "string"),
                 "recommended_action": (4, "string")}


def _segment_attr(name: str):
    pos, typ = SEGMENT_ATTRS[name]
    by_name = F.create_map(*[x for r in segment_dimension_expr_rows() for x in (F.lit(r[1]), F.lit(r[pos]))])
    return F.try_element_at(by_name, F.col("segment_name")).cast(typ).alias(name)


def star_join(fact: DataFrame, dim_employer: DataFrame, group_by=("segment_name",),
              date_attrs=("year",)) -> DataFrame:
    """DIM5: interactions counted by attributes of the employer, segment and date dimensions.

    ``group_by`` takes columns of ``dim_employer`` and the segment attributes (segment_id, priority, color_hex,
    recommended_action), ``date_attrs`` the columns of the date dimension. The fact is pre-aggregated per
    (employer, day) before it meets the employer dimension, so a hot employer contributes one row per day to the
    join; segment and date attributes are derived from their keys (no table to join).
    """
    per_day = fact.groupBy("employer_id", F.col("interaction_date").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    date_exprs = {"year": F.year("date"), "quarter": F.quarter("date"), "month": F.month("date"),
                  "month_start": F.trunc("date", "month").cast("date"), "month_end": F.last_day("date"),
                  "day_of_week": F.dayofweek("date"), "date": F.col("date")}
    derived = [c for c in group_by if c not in dim_employer.columns]
    unknown = [c for c in derived if c not in SEGMENT_ATTRS] + [a for a in date_attrs if a not in date_exprs]
    if unknown:
        raise ValueError(f"no dimension has columns {unknown}")
    stored = list(dict.fromkeys([c for c in group_by if c in dim_employer.columns and c != "employer_id"]
                                + (["segment_name"] if derived else [])))
    joined = per_day.join(dim_employer.select("employer_id", *stored), "employer_id", "left")
    keys = [_segment_attr(c) if c in derived else F.col(c) for c in group_by] + [date_exprs[a].alias(a) for a in date_attrs]
    return joined.groupBy(*keys).agg(F.sum("n").cast("long").alias("interactions"),
                                     F.count_distinct("employer_id").cast("long").alias("employers"))
