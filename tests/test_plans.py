"""Plan properties the design relies on (see PLANS.md), checked on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

FIT_QUERIES = {"seg7_kmeans_clusters", "seg11_fit_transform", "seg12_kmeans_segment_sizes", "prf2_kmeans_segment_report"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - FIT_QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name,needle", [("flt1_date_cutoff", "GreaterThanOrEqual(o_orderdate"),
                                         ("ext2_retain_interactions", "GreaterThanOrEqual(o_orderdate")])
def test_date_and_value_filters_reach_the_scan(spark, name, needle):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "PushedFilters" in plan and needle in plan


def test_filters_on_a_loaded_file_reach_the_scan(spark):
    from accountlens.sources.files import load_file
    plan = plan_of(load_file(spark, f"{SF}/customer.parquet").where("c_acctbal > 0").select("c_custkey"))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(entry.queries()["m14_period_window"](spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_contact_features_one_exchange_before_join(spark):
    from accountlens.operators.features import contact_features
    from accountlens.sources import testdata as td
    plan = plan_of(contact_features(td.interactions(spark, SF), td.AS_OF))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan
