"""KPI measures (M1-M13, GLO1-GLO2) as DataFrame functions.

``by`` plays the role of the BI filter context: measures return one row per
group of ``by`` (or one row when empty). Employer attributes reach the
interaction fact through a join on employer_id performed after the fact has
been pre-aggregated per (employer, day), so skewed employers never reach the
join with more than one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountlens import constants as C
from accountlens.functions.expressions import as_date_lit, in_months_window, safe_divide
from accountlens.operators.calendar import monthly_counts, null_safe_join, previous_month
from accountlens.session import materialize


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def active_employers(employers: DataFrame, by=()) -> DataFrame:
    """M1: employers with status 'Active'."""
    return employers.groupBy(*_by(by)).agg(F.count_if(F.col("status") == "Active").cast("long").alias("active_employers"))


def daily_fact(interactions: DataFrame, employers: DataFrame | None = None, by=(),
               date_col: str = "interaction_date") -> DataFrame:
    """Interactions per (group, day): the aggregate all interaction measures start from."""
    by = _by(by)
    if not by:
        return (interactions.groupBy(F.col(date_col).cast("date").alias("date"))
                .agg(F.count(F.lit(1)).cast("long").alias("interactions")))
    per_emp_day = (interactions.groupBy("employer_id", F.col(date_col).cast("date").alias("date"))
                   .agg(F.count(F.lit(1)).alias("n")))
    if by:
        if employers is None:
            raise ValueError("grouping by employer attributes needs the employer table")
        attrs = employers.select("employer_id", *by)
        per_emp_day = per_emp_day.join(attrs, "employer_id", "left")
    return per_emp_day.groupBy(*by, "date").agg(F.sum("n").cast("long").alias("interactions"))


def avg_interactions_per_employer(interactions: DataFrame, employers: DataFrame, by=(),
                                  months: int = C.CHURN_WINDOW_MONTHS) -> DataFrame:
    """M2: interactions in the ``months`` ending at the last interaction date of the group / M1 (0 if none)."""
    by = _by(by)
    daily = daily_fact(interactions, employers, by)
    if by:
        # the group's last date via a window over its (<= days) aggregated rows: no self-join
        last = F.max("date").over(Window.partitionBy(*by))
        in_window = in_months_window(F.col("date"), F.col("last_date"), months)
        num = daily.withColumn("last_date", last).groupBy(*by).agg(
            F.sum(F.when(in_window, F.col("interactions"))).cast("long").alias("interactions_12m"))
        # union and groupBy instead of a join: the null group meets itself
        den = active_employers(employers, by).withColumn("interactions_12m", F.lit(None).cast("long"))
        both = num.withColumn("active_employers", F.lit(None).cast("long")).unionByName(den)
        joined = both.groupBy(*by).agg(F.max("interactions_12m").alias("interactions_12m"),
                                       F.max("active_employers").alias("active_employers"))
    else:
        # global context: the last date is one value, used as a literal
        last_date = daily.agg(F.max("date")).first()[0]
        num = daily.agg(F.sum(F.when(in_months_window(F.col("date"), F.lit(last_date), months),
                                     F.col("interactions"))).cast("long").alias("interactions_12m"),
                        F.lit(None).cast("long").alias("active_employers"))
        den = active_employers(employers).select(F.lit(None).cast("long").alias("interactions_12m"),
                                                 "active_employers")
        joined = num.unionByName(den).agg(F.max("interactions_12m").alias("interactions_12m"),
                                           F.max("active_employers").alias("active_employers"))
    n = F.coalesce(F.col("interactions_12m"), F.lit(0)).cast("long")
    d = F.coalesce(F.col("active_employers"), F.lit(0)).cast("long")
    return joined.select(*by, n.alias("interactions_12m"), d.alias("active_employers"),
                         safe_divide(n, d, 0).alias("avg_interactions_per_employer"))


def total_revenue_potential(employers: DataFrame, by=()) -> DataFrame:
    """M3: sum of revenue_potential."""
    return employers.groupBy(*_by(by)).agg(F.sum("revenue_potential").alias("total_revenue_potential"))


def churn_risk(employers: DataFrame, interactions: DataFrame, as_of,
               months: int = C.CHURN_WINDOW_MONTHS, keep=()) -> DataFrame:
    """M4 per employer: round((min(days/365, 1) * 0.6 + (1 - min(freq12m/24, 1)) * 0.4) * 100, 0).

    days = as_of - last interaction; freq = interactions in the ``months`` ending
    at as_of. Employers without interactions score as fully stale (100).
    One aggregation (partial per partition) and one key-unique join.
    """
    end = as_of_date = as_date_lit(as_of)
    per = interactions.groupBy("employer_id").agg(
        F.max(F.col("interaction_date").cast("date")).alias("last_interaction_date"),
        F.count_if(in_months_window(F.col("interaction_date"), end, months)).cast("long").alias("interactions_12m"))
    keep = [c for c in _by(keep) if c != "employer_id"]
    joined = employers.select("employer_id", *keep).join(per, "employer_id", "left")
    days = F.datediff(as_of_date, F.col("last_interaction_date"))
    norm_r = F.when(days.isNull(), F.lit(1.0)).otherwise(
        F.least(days.cast("double") / F.lit(float(C.CHURN_RECENCY_DAYS)), F.lit(1.0)))
    freq = F.coalesce(F.col("interactions_12m"), F.lit(0))
    norm_f = F.lit(1.0) - F.least(freq.cast("double") / F.lit(float(C.CHURN_FREQUENCY_CAP)), F.lit(1.0))
    w = C.CHURN_WEIGHTS
    score = F.round((norm_r * F.lit(w["recency"]) + norm_f * F.lit(w["frequency"])) * F.lit(100.0), 0)
    return joined.select("employer_id", *keep, "last_interaction_date", days.cast("long").alias("days_since_contact"),
                         freq.cast("long").alias("interactions_12m"), score.alias("churn_risk_score"))


def pct_high_churn(employers: DataFrame, interactions: DataFrame, as_of, by=(),
                   threshold: float = C.HIGH_CHURN_THRESHOLD, inclusive: bool = False) -> DataFrame:
    """M5 (and GLO2 with ``inclusive=True``): employers scoring above the threshold / active employers, else 0."""
    by = _by(by)
    base = churn_risk(employers, interactions, as_of, keep=["status", *by])
    s = F.col("churn_risk_score")
    high = (s >= threshold) if inclusive else (s > threshold)
    agg = base.groupBy(*by).agg(F.count_if(high).cast("long").alias("high_churn_employers"),
                                F.count_if(F.col("status") == "Active").cast("long").alias("active_employers"))
    return agg.withColumn("pct_high_churn", safe_divide(F.col("high_churn_employers"), F.col("active_employers"), 0))


def priority_label_expr(score: Column, revenue: Column) -> Column:
    """M6: first matching rule of the priority label table."""
    expr = None
    for bound, rev_floor, label in C.PRIORITY_LABELS:
        if bound is None:
            return expr.otherwise(F.lit(label))
        cond = score < F.lit(bound)
        if rev_floor is not None:
            cond = cond & (revenue > F.lit(rev_floor))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def segment_priority_labels(employers: DataFrame, interactions: DataFrame, as_of) -> DataFrame:
    """M6 at employer grain: churn score and revenue -> label."""
    base = churn_risk(employers, interactions, as_of, keep=["revenue_potential"]).select(
        "employer_id", "revenue_potential", "churn_risk_score")
    return base.withColumn("priority_label",
                           priority_label_expr(F.col("churn_risk_score"), F.coalesce("revenue_potential", F.lit(0.0))))


def segment_share(segmented: DataFrame, by=(), segment_col: str = "segment_name") -> DataFrame:
    """M7: rows per segment / rows of all segments under the same other grouping (0 if none)."""
    by = _by(by)
    counts = segmented.groupBy(*by, segment_col).agg(F.count(F.lit(1)).cast("long").alias("employers"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return counts.withColumn("segment_share", safe_divide(F.col("employers"), F.sum("employers").over(w), 0))


def interactions_ytd(interactions: DataFrame, employers: DataFrame | None = None, by=(),
                     dense: bool = True) -> DataFrame:
    """M8: per dense month, interactions from 1 January to the end of that month."""
    by = _by(by)
    fact = _attach(interactions, employers, by)
    counts = monthly_counts(fact, "interaction_date", by, dense, "n")
    w = (Window.partitionBy(*by, F.year("month_start")).orderBy("month_start")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.withColumn("interactions_ytd", F.sum("interactions").over(w).cast("long"))


def mom_growth(interactions: DataFrame, employers: DataFrame | None = None, by=(), basis: str = "ytd",
               dense: bool = True) -> DataFrame:
    """M9: (current - previous month) / previous month; null when the previous month is 0.

    ``basis='ytd'`` follows the documented measure, whose "current" value is the
    YTD count; ``basis='month'`` compares plain monthly counts.
    """
    by = _by(by)
    ytd = interactions_ytd(interactions, employers, by, dense)
    with_prev = previous_month(ytd, "interactions", by, "previous_month")
    cur = F.col("interactions_ytd") if basis == "ytd" else F.col("interactions")
    prev = F.col("previous_month")
    return with_prev.withColumn("mom_growth", safe_divide(cur - prev, prev))


def rolling_3m(interactions: DataFrame, employers: DataFrame | None = None, by=(),
               months: int = C.ROLLING_WINDOW_MONTHS, dense: bool = True) -> DataFrame:
    """M10 per month: mean daily count over the days with interactions in the ``months`` ending at month end,
    or at the calendar's last day in the last month, where the daily form ends too.

    Each (group, day) row is sent to the month ends whose window contains it
    (at most ``months`` + 1 candidates, filtered exactly); no range join.
    """
    by = _by(by)
    daily, _, last_day = _daily_counts(interactions, employers, by)
    exploded = daily.select(*by, "date", F.col("n").alias("interactions"), F.explode(F.sequence(F.lit(0), F.lit(months))).alias("k"))
    exploded = exploded.withColumn("month_end", F.least(
        F.last_day(F.add_months(F.col("date"), F.col("k").cast("int"))), F.lit(last_day).cast("date")))
    # the months beyond the calendar end collapse onto it: one row per (day, month end)
    inside = exploded.filter(in_months_window(F.col("date"), F.col("month_end"), months)).drop("k").distinct()
    agg = inside.groupBy(*by, "month_end").agg(F.sum("interactions").cast("long").alias("window_interactions"),
                                             F.count(F.lit(1)).cast("long").alias("active_days"))
    counts = monthly_counts(daily, "date", by, dense, "n")
    counts = counts.withColumn("month_end", F.least(F.last_day("month_start"), F.lit(last_day).cast("date")))
    out = null_safe_join(counts, agg, [*by, "month_end"])
    return out.select(*by, "month_start", "interactions",
                      safe_divide(F.col("window_interactions"), F.col("active_days")).alias("rolling_3m_interactions"))


def _rolling_steps(daily: DataFrame, by: list, months: int) -> DataFrame:
    """One row for each day on which the rolling window of a group changes: ``date``, ``interactions`` of that day, the
    window's ``window_interactions`` and ``active_days``, and ``next_date``, the group's next change (null: none).

    ``daily`` has one row per (group, date) with its count ``n``. A day enters the window on its own date and leaves it on
    the first date x with ``add_months(x, -months) >= date``: the same day of a later month or, where that month is too
    short to have it, the first of the month after. Both events come out of one pass over ``daily``; a running sum over
    the events of a group is the window.
    """
    later = F.add_months("date", months)
    leaves = F.when(F.add_months(later, -months) >= F.col("date"), later).otherwise(F.date_add(later, 1))
    n = F.col("n").cast("long")
    events = F.explode(F.array(
        F.struct(F.col("date"), n.alias("interactions"), n.alias("change"), F.lit(1).alias("days")),
        F.struct(leaves.alias("date"), F.lit(0).cast("long").alias("interactions"), (-n).alias("change"),
                 F.lit(-1).alias("days")))).alias("event")
    steps = daily.select(*by, events).select(*by, "event.*").groupBy(*by, "date").agg(
        *[F.sum(c).alias(c) for c in ("interactions", "change", "days")])
    order = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("date")
    until_now = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.select(*by, "date", "interactions", F.sum("change").over(until_now).alias("window_interactions"),
                        F.sum("days").over(until_now).alias("active_days"), F.lead("date").over(order).alias("next_date"))


def _daily_counts(interactions: DataFrame, employers: DataFrame | None, by: list) -> tuple[DataFrame, object, object]:
    """The (group, date) counts ``n``, computed once, with their first and last date; rows without a date take no part."""
    daily = materialize(_attach(interactions, employers, by).where(F.col("interaction_date").isNotNull())
                        .select(*by, F.col("interaction_date").alias("date"), "n"))
    return daily, *daily.agg(F.min("date"), F.max("date")).first()


def rolling_3m_changes(interactions: DataFrame, employers: DataFrame | None = None, by=(),
                       months: int = C.ROLLING_WINDOW_MONTHS) -> DataFrame:
    """M10 at day grain without the calendar: one row for each stretch of days on which a group's rolling value stands.

    ``date`` to ``until`` (both included) is the stretch, ``interactions`` the count of its first day (the others have
    none). A group has at most two rows for each of its active days, however long the calendar, so grouping by employer
    stays in proportion to the interactions. The last stretch ends with the calendar: the last interaction of all groups.
    """
    by = _by(by)
    daily, _, hi = _daily_counts(interactions, employers, by)
    end = F.lit(hi).cast("date")
    return _rolling_steps(daily, by, months).where(F.col("date") <= end).select(
        *by, "date", F.least(F.date_sub("next_date", 1), end).alias("until"), "interactions",
        safe_divide(F.col("window_interactions"), F.col("active_days")).alias("rolling_3m_interactions"))


def rolling_3m_daily(interactions: DataFrame, employers: DataFrame | None = None, by=(),
                     months: int = C.ROLLING_WINDOW_MONTHS) -> DataFrame:
    """M10 at day grain: for every calendar day d, the mean daily count over the days with
    interactions in ``(add_months(d, -months), d]``.

    The rows of ``rolling_3m_changes`` spread over their days, and each group's days before its first interaction: a
    row for every (group, day) of the calendar. For many groups use ``rolling_3m_changes``.
    """
    by = _by(by)
    daily, lo, hi = _daily_counts(interactions, employers, by)
    steps = _rolling_steps(daily, by, months)
    order = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("date")
    start = F.when(F.row_number().over(order) == 1, F.lit(lo).cast("date")).otherwise(F.col("date"))
    end = F.lit(hi).cast("date")
    spread = (steps.withColumn("start", start).where(F.col("date") <= end)
              .withColumn("day", F.explode(F.sequence("start", F.least(F.date_sub("next_date", 1), end)))))
    value = safe_divide(F.col("window_interactions"), F.col("active_days"))
    return spread.select(*by, F.col("day").alias("date"),
                         F.when(F.col("day") == F.col("date"), F.col("interactions")).otherwise(0).alias("interactions"),
                         F.when(F.col("day") >= F.col("date"), value).alias("rolling_3m_interactions"))


def _attach(interactions: DataFrame, employers: DataFrame | None, by) -> DataFrame:
    """Counts ``n`` per (``by``, interaction_date). Employer attributes join an aggregate per (employer, day), so the
    raw fact is read once and a hot employer brings at most one row a day (and own column) to the join."""
    own = [b for b in by if b in interactions.columns]
    day = F.col("interaction_date").cast("date").alias("interaction_date")
    if len(own) == len(by):
        return interactions.groupBy(*by, day).agg(F.count(F.lit(1)).alias("n"))
    if employers is None:
        raise ValueError("grouping by employer attributes needs the employer table")
    keys = list(dict.fromkeys(["employer_id", *own]))
    per_day = interactions.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("n"))
    attributes = employers.select("employer_id", *[b for b in by if b not in own])
    joined = per_day.join(attributes, "employer_id", "left")
    return joined.groupBy(*by, "interaction_date").agg(F.sum("n").alias("n"))


def avg_time_to_fill(vacancies: DataFrame, by=()) -> DataFrame:
    """M11: mean days from open to filled; unfilled vacancies are skipped."""
    return vacancies.groupBy(*_by(by)).agg(
        F.avg(F.datediff("filled_date", "open_date")).alias("avg_time_to_fill"))


def placement_ratio(vacancies: DataFrame, by=()) -> DataFrame:
    """M12: filled vacancies / all vacancies, 0 when there are none."""
    agg = vacancies.groupBy(*_by(by)).agg(F.count_if(F.col("status") == "Filled").cast("long").alias("filled"),
                                          F.count(F.lit(1)).cast("long").alias("vacancies"))
    return agg.withColumn("placement_ratio", safe_divide(F.col("filled"), F.col("vacancies"), 0))


def active_employers_glossary(employers: DataFrame, interactions: DataFrame, as_of,
                              months: int = C.CHURN_WINDOW_MONTHS) -> DataFrame:
    """GLO1: status 'Active' AND at least one interaction in the ``months`` ending at as_of.

    The recent interactions are reduced to distinct employer ids before the semi
    join, so a hot employer contributes one key.
    """
    recent = (interactions.filter(in_months_window(F.col("interaction_date"), as_of, months))
              .select("employer_id").distinct())
    return employers.filter(F.col("status") == "Active").join(recent, "employer_id", "left_semi")
