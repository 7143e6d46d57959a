"""KPI measures and time intelligence (M1-M15, GLO1-GLO2, DIM1)."""

import calendar
import datetime as dt
import random
from collections import Counter
from datetime import timedelta

import pytest

from accountlens.operators import measures as ms
from accountlens.operators.calendar import date_dimension, monthly_counts, previous_month

D = dt.date


@pytest.fixture
def employers(spark):
    return spark.createDataFrame(
        [("E1", "Active", "tech", 60000.0), ("E2", "Active", "tech", 10000.0), ("E3", "Inactive", "retail", 5000.0),
         ("E4", "Active", "retail", 80000.0)],
        "employer_id string, status string, sector string, revenue_potential double")


@pytest.fixture
def interactions(spark):
    rows = [("E1", D(2024, 1, 31)), ("E1", D(2024, 2, 29)), ("E1", D(2024, 2, 29)), ("E2", D(2024, 4, 30)),
            ("E2", D(2023, 4, 30)), ("E3", D(2024, 5, 1)), ("E3", D(2023, 5, 1)), ("E1", D(2025, 1, 15))]
    return spark.createDataFrame([(f"I{i}", e, d) for i, (e, d) in enumerate(rows)],
                                 "interaction_id string, employer_id string, interaction_date date")


def test_m1_m3(employers):
    assert ms.active_employers(employers).first()[0] == 3
    by = {r["sector"]: r["total_revenue_potential"] for r in ms.total_revenue_potential(employers, "sector").collect()}
    assert by == {"tech": 70000.0, "retail": 85000.0}


def test_m2_window_ends_at_last_date(interactions, employers):
    r = ms.avg_interactions_per_employer(interactions, employers).first()
    # last date 2025-01-15: window (2024-01-15, 2025-01-15] holds 6 interactions
    assert r["interactions_12m"] == 6 and r["active_employers"] == 3
    assert r["avg_interactions_per_employer"] == pytest.approx(6 / 3)


def test_m2_zero_denominator(spark, interactions):
    emp = spark.createDataFrame([("E1", "Inactive")], "employer_id string, status string")
    assert ms.avg_interactions_per_employer(interactions, emp).first()["avg_interactions_per_employer"] == 0.0


def test_m4_churn_score(spark, employers, interactions):
    rows = {r["employer_id"]: r for r in ms.churn_risk(employers, interactions, D(2025, 2, 1)).collect()}
    # E1: last 2025-01-15 -> 17 days; window (2024-02-01, 2025-02-01]: 2 on 2024-02-29 + 2025-01-15 = 3
    exp = round((17 / 365 * 0.6 + (1 - 3 / 24) * 0.4) * 100)
    assert rows["E1"]["days_since_contact"] == 17 and rows["E1"]["interactions_12m"] == 3
    assert rows["E1"]["churn_risk_score"] == exp
    assert rows["E4"]["churn_risk_score"] == 100.0 and rows["E4"]["last_interaction_date"] is None


def test_m5_m6_glo2(spark, employers, interactions):
    r = ms.pct_high_churn(employers, interactions, D(2025, 2, 1)).first()
    scores = {x["employer_id"]: x["churn_risk_score"] for x in ms.churn_risk(employers, interactions, D(2025, 2, 1)).collect()}
    assert r["high_churn_employers"] == sum(1 for s in scores.values() if s > 70)
    assert r["pct_high_churn"] == pytest.approx(r["high_churn_employers"] / 3)
    inc = ms.pct_high_churn(employers, interactions, D(2025, 2, 1), inclusive=True).first()
    assert inc["high_churn_employers"] >= r["high_churn_employers"]
    labels = {x["employer_id"]: x["priority_label"] for x in ms.segment_priority_labels(employers, interactions, D(2025, 2, 1)).collect()}
    assert labels["E4"].endswith("Lost")


def test_m6_label_rules(spark):
    df = spark.createDataFrame([(10.0, 60000.0), (10.0, 1000.0), (39.0, 0.0), (69.0, 0.0), (70.0, 0.0)], "s double, r double")
    from pyspark.sql import functions as F
    got = [x[0] for x in df.select(ms.priority_label_expr(F.col("s"), F.col("r"))).collect()]
    assert [g.split(" ")[1] for g in got] == ["Champion", "Potential", "Potential", "At", "Lost"]


def test_m7_share(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "x"), ("B", "x"), ("A", "y")], "segment_name string, status string")
    rows = {(r["status"], r["segment_name"]): r["segment_share"] for r in ms.segment_share(df, ["status"]).collect()}
    assert rows == {("x", "A"): pytest.approx(2 / 3), ("x", "B"): pytest.approx(1 / 3), ("y", "A"): 1.0}


def test_m8_ytd_and_m9_growth_dense_months(interactions):
    rows = {r["month_start"]: r for r in ms.mom_growth(interactions).collect()}
    assert len(rows) == 22  # 2023-04 .. 2025-01, empty months included
    assert rows[D(2023, 6, 1)]["interactions"] == 0 and rows[D(2023, 6, 1)]["interactions_ytd"] == 2
    assert rows[D(2024, 2, 1)]["interactions_ytd"] == 3
    assert rows[D(2024, 2, 1)]["mom_growth"] == pytest.approx((3 - 1) / 1)
    assert rows[D(2024, 3, 1)]["mom_growth"] == pytest.approx((3 - 2) / 2)
    assert rows[D(2024, 4, 1)]["mom_growth"] is None  # previous month had 0
    assert rows[D(2025, 1, 1)]["interactions_ytd"] == 1
    true_mom = {r["month_start"]: r for r in ms.mom_growth(interactions, basis="month").collect()}
    assert true_mom[D(2024, 3, 1)]["mom_growth"] == pytest.approx(-1.0)


def test_m10_rolling_mean_over_active_days(interactions):
    rows = {r["month_start"]: r["rolling_3m_interactions"] for r in ms.rolling_3m(interactions).collect()}
    # window for April 2024: (2024-01-30, 2024-04-30]: days 01-31 (1), 02-29 (2), 04-30 (1)
    assert rows[D(2024, 4, 1)] == pytest.approx(4 / 3)
    # window for May 2024: (2024-02-29, 2024-05-31] -> days 04-30 and 05-01
    assert rows[D(2024, 5, 1)] == pytest.approx(1.0)
    assert rows[D(2024, 10, 1)] is None


def test_m11_m12(spark):
    v = spark.createDataFrame([("V1", D(2024, 1, 1), D(2024, 1, 11), "Filled"), ("V2", D(2024, 1, 1), None, "Open"),
                               ("V3", D(2024, 1, 1), D(2024, 1, 21), "Filled")],
                              "vacancy_id string, open_date date, filled_date date, status string")
    assert ms.avg_time_to_fill(v).first()[0] == 15.0
    assert ms.placement_ratio(v).first()["placement_ratio"] == pytest.approx(2 / 3)
    assert ms.placement_ratio(v.filter("false")).count() == 1


def test_glo1(employers, interactions):
    ids = {r["employer_id"] for r in ms.active_employers_glossary(employers, interactions, D(2025, 2, 1)).collect()}
    assert ids == {"E1", "E2"}


def test_dim1_calendar(interactions):
    cal = date_dimension(interactions)
    assert cal.count() == (D(2025, 1, 15) - D(2023, 4, 30)).days + 1
    leap = cal.filter("date = DATE'2024-02-29'").first()
    assert leap["month_end"] == D(2024, 2, 29) and leap["month_start"] == D(2024, 2, 1)


def test_previous_month_by_group(interactions, employers):
    c = previous_month(monthly_counts(interactions.join(employers, "employer_id"), by=["sector"]), by=["sector"])
    rows = {(r["sector"], r["month_start"]): r["previous_month"] for r in c.collect()}
    assert rows[("tech", D(2024, 3, 1))] == 2 and rows[("retail", D(2023, 4, 1))] is None


def test_m10_daily_grain(interactions, employers):
    rows = {r["date"]: r["rolling_3m_interactions"] for r in ms.rolling_3m_daily(interactions).collect()}
    # day 2024-04-30: window (2024-01-30, 2024-04-30] -> 01-31 (1), 02-29 (2), 04-30 (1) over 3 active days
    assert rows[D(2024, 4, 30)] == pytest.approx(4 / 3)
    assert rows[D(2024, 1, 30)] is None or rows[D(2024, 1, 30)] == pytest.approx(1.0)
    by = {(r["sector"], r["date"]): r["rolling_3m_interactions"]
          for r in ms.rolling_3m_daily(interactions, employers, by=["sector"]).collect()}
    assert by[("tech", D(2024, 4, 30))] == pytest.approx(4 / 3)
    assert by[("retail", D(2024, 5, 1))] == pytest.approx(1.0)


def _window_start(day, months):
    """``day`` some months earlier, or that month's last day."""
    month = day.year * 12 + day.month - 1 - months
    last = calendar.monthrange(month // 12, month % 12 + 1)[1]
    return D(month // 12, month % 12 + 1, min(day.day, last))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_m10_changes_and_days_by_definition(spark, seed):
    """Changes by employer, spread over their days, and the daily form: both equal the mean over the window's days."""
    rng = random.Random(seed)
    first = D(2023, 11, 25)
    facts = [(rng.choice(["a", "b", None]), first + timedelta(days=rng.choice([3, 5, 6, 35, 95, 96, rng.randrange(300)])))
             for _ in range(60)] + [("late", D(2024, 8, 31)), ("early", first), ("a", None)]
    inter = spark.createDataFrame(facts, "employer_id string, interaction_date date")
    counts = Counter(f for f in facts if f[1])
    lo, hi = min(d for _, d in counts), max(d for _, d in counts)
    want = {}
    for e in {e for e, _ in counts}:
        for k in range((hi - lo).days + 1):
            day = lo + timedelta(days=k)
            inside = [n for (x, d), n in counts.items() if x == e and _window_start(day, 3) < d <= day]
            want[e, day] = (counts.get((e, day), 0), sum(inside) / len(inside) if inside else None)
    changes = ms.rolling_3m_changes(inter, by=["employer_id"]).collect()
    assert len(changes) <= 2 * len(counts)
    spread = {}
    for r in changes:
        for k in range((r["until"] - r["date"]).days + 1):
            key = r["employer_id"], r["date"] + timedelta(days=k)
            assert key not in spread
            spread[key] = (0 if k else r["interactions"], r["rolling_3m_interactions"])
    assert spread == {k: v for k, v in want.items() if k in spread}
    assert all(v == (0, None) for k, v in want.items() if k not in spread)
    daily = ms.rolling_3m_daily(inter, by=["employer_id"]).collect()
    assert len(daily) == len(want)
    assert {(r["employer_id"], r["date"]): (r["interactions"], r["rolling_3m_interactions"]) for r in daily} == want


def test_m10_daily_of_nothing_and_its_plan(spark, interactions):
    nothing = interactions.where("1 = 0")
    assert ms.rolling_3m_daily(nothing).collect() == [] == ms.rolling_3m_changes(nothing, by=["employer_id"]).collect()
    plan = ms.rolling_3m_changes(interactions, by=["employer_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_sparse_months_same_values(interactions):
    dense = {r["month_start"]: r for r in ms.mom_growth(interactions).collect()}
    sparse = {r["month_start"]: r for r in ms.mom_growth(interactions, dense=False).collect()}
    assert set(sparse) < set(dense)
    for m, r in sparse.items():
        assert r["interactions_ytd"] == dense[m]["interactions_ytd"]
        assert r["mom_growth"] == dense[m]["mom_growth"]
