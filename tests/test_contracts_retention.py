"""Contracts (CON1-CON8) in all modes, retention (EXT1-EXT2), row-level security (EXT5), star schema (DIM2-DIM5)."""

import datetime as dt

import pytest

from accountlens.operators import contracts as con
from accountlens.operators import retention as rt
from accountlens.operators import star

D = dt.date


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(
        [("E1", "small", "Active", "tech", 10.0, "2025-01-01", 3), ("E1", "giant", "Active", "tech", -1.0, None, 1),
         (None, "small", "Unknown", "mining", None, None, -2), ("E4", "large", "Prospect", None, 5.0, None, None)],
        "employer_id string, company_size string, status string, sector string, revenue_potential double, "
        "last_contact_date string, frequency_12m long")


def test_report_mode(dirty):
    rows = {(r["column_name"], r["check_name"]): r["failed_rows"] for r in
            con.validate_contract(dirty, con.EMPLOYER_CONTRACT, "report").collect()}
    assert rows[("employer_id", "not_nullable")] == 1
    assert rows[("employer_id", "unique")] == 2
    assert rows[("company_size", "isin")] == 1
    assert rows[("status", "isin")] == 1
    assert rows[("sector", "isin")] == 1          # null passes a nullable value set
    assert rows[("revenue_potential", "greater_than(0)")] == 1
    assert rows[("frequency_12m", "greater_than_or_equal_to(0)")] == 1


def test_raise_and_quarantine(dirty):
    with pytest.raises(con.ContractError):
        con.validate_contract(dirty, con.EMPLOYER_CONTRACT)
    good, bad = con.validate_contract(dirty, con.EMPLOYER_CONTRACT, "quarantine")
    assert {r["employer_id"] for r in good.collect()} == {"E4"}
    assert bad.count() == 3


def test_missing_columns_reported(dirty):
    rows = con.violations(dirty.drop("sector"), con.EMPLOYER_CONTRACT).filter("check_name = 'column_in_dataframe'").collect()
    assert [r["column_name"] for r in rows] == ["sector"]


def test_valid_frame_passes_and_coerces(spark):
    df = spark.createDataFrame([("E1", "small", "Active", "tech", "10", "2025-01-01", "5.0")],
                               "employer_id string, company_size string, status string, sector string, "
                               "revenue_potential string, last_contact_date string, frequency_12m string")
    out = con.validate_contract(df, con.EMPLOYER_CONTRACT)
    assert dict(out.dtypes)["revenue_potential"] == "double" and out.first()["frequency_12m"] == 5


def test_retention(spark):
    emp = spark.createDataFrame([("E1",), ("E2",), ("E3",)], "employer_id string")
    inter = spark.createDataFrame([("E1", D(2023, 6, 1)), ("E2", D(2023, 5, 31)), ("E1", D(2022, 6, 1)),
                                   ("E1", D(2022, 5, 31))], "employer_id string, interaction_date date")
    kept = {r["employer_id"]: r["never_contacted"] for r in rt.retain_employers(emp, inter, D(2025, 6, 1)).collect()}
    assert kept == {"E1": False, "E3": True}          # exactly 24 months is kept
    dates = sorted(r[0] for r in rt.retain_interactions(inter, D(2025, 6, 1)).select("interaction_date").collect())
    assert dates == [D(2022, 6, 1), D(2023, 5, 31), D(2023, 6, 1)]   # exactly 36 months is kept


def test_row_level_security(spark):
    emp = spark.createDataFrame([("E1", "a"), ("E2", "b"), ("E3", "c")], "employer_id string, name string")
    inter = spark.createDataFrame([("C1", "E1"), ("C1", "E1"), ("C2", "E2"), ("C1", "E3")],
                                  "consultant_id string, employer_id string")
    assert {r["employer_id"] for r in rt.visible_employers(emp, inter, "C1").collect()} == {"E1", "E3"}
    assert rt.visible_employers(emp, inter).count() == 3


def test_star(spark):
    seg = spark.createDataFrame([("E1", 0, "Champions", "tech"), ("E2", 3, "Lost", "retail")],
                                "employer_id string, segment_id int, segment_name string, sector string")
    dim = {r["segment_id"]: r for r in star.segment_dimension(seg).collect()}
    assert dim[0]["color_hex"] == "#22c55e" and dim[3]["priority"] == 4
    fact = star.interaction_fact(spark.createDataFrame([("I1", "E1", "2024-01-05", "1"), ("I2", "E1", "2024-01-05", "0"),
                                                        ("I3", "E2", "2025-02-01", "1")],
                                                       "interaction_id string, employer_id string, "
                                                       "interaction_date string, follow_up_required string"))
    assert dict(fact.dtypes)["interaction_date"] == "date"
    rows = {(r["segment_name"], r["year"]): (r["interactions"], r["employers"])
            for r in star.star_join(fact, star.employer_dimension(seg)).collect()}
    assert rows == {("Champions", 2024): (2, 1), ("Lost", 2025): (1, 1)}


def test_star_join_over_segment_and_date_attributes(spark):
    import datetime as dt

    import pytest

    from accountlens.operators import star
    fact = spark.createDataFrame([("i1", "e1", dt.date(2025, 6, 1)), ("i2", "e1", dt.date(2025, 6, 1)), ("i3", None, None)],
                                 "interaction_id string, employer_id string, interaction_date date")
    dim = spark.createDataFrame([("e1", "Champions", "retail")], "employer_id string, segment_name string, sector string")
    out = star.star_join(fact, dim, ("color_hex", "segment_id", "sector"), ("day_of_week", "month_end"))
    assert {tuple(r) for r in out.collect()} == {("#22c55e", 0, "retail", 1, dt.date(2025, 6, 30), 2, 1),
                                                 (None, None, None, None, None, 1, 0)}
    for group_by, dates in ((("shoe_size",), ("year",)), (("sector",), ("moon",))):
        with pytest.raises(ValueError, match="no dimension"):
            star.star_join(fact, dim, group_by, dates)


def test_quarantine_of_null_keys_without_a_join(spark):
    """Several null keys of a nullable unique column are duplicates of each other, a single one is not; a hot null key meets no join."""
    contract = con.Contract("t", (con.ColumnRule("k", "string", nullable=True, unique=True),))
    rows = [(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)]
    for data, good_rows in ((rows, {5}), (rows[1:], {2, 5})):
        good, bad = con.validate_contract(spark.createDataFrame(data, "k string, n int"), contract, "quarantine")
        assert {r["n"] for r in good.collect()} == good_rows
        assert {r["n"] for r in bad.collect()} == {n for _, n in data} - good_rows
    strict = con.Contract("t", (con.ColumnRule("k", "string", nullable=False, unique=True),))
    good, bad = con.validate_contract(spark.createDataFrame([(None, 0)] * 50 + rows, "k string, n int"), strict, "quarantine")
    assert {r["n"] for r in good.collect()} == {5} and bad.count() == 54
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert "<=>" not in plan
