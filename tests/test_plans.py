"""Physical plans of the registered queries, as they would run on large tables."""

import re
from collections import Counter

import pytest

from wardlake.contracts import SOURCES
from wardlake.operators import star
from wardlake.registry import OPEN_RUNS, QUERIES, Bound

SF = "/root/testdata/sf0.001"

# These write tables first and return a scan of them.
WRITING = {
    "scan_landing_csv", "landing_csv_round_trip", "landing_manifest", "column_contract_report",
    "provenance_columns", "scan_bronze_parquet", "bronze_round_trip", "silver_replace_idempotent",
    "gold_round_trip", "external_gold_scan", "raw_layer_counts", "silver_layer_counts",
    "gold_layer_counts", "audit_log", "audit_recent", "audit_by_layer", "audit_run_health",
    "layer_reconciliation", "header_contract_cases", "history_claim_views", "gold_row_counts",
    "vw_rejected_claims_ranking", "raw_balance", "preview_rejected_claims_ranking",
    "silver_published_together", "content_reconciliation", "content_reconciliation_swapped",
}


def plan_of(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def large_plans(spark):
    """Plans for sizes as on a cluster: no table of the bound data counts as small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = {name: plan_of(spark, name) for name in sorted(set(QUERIES) - WRITING)}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return plans


def test_no_cross_join_no_python_no_forced_broadcast(large_plans):
    unwanted = ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "Python",
                "MapInPandas", "ResolvedHint")
    found = {(name, op) for name, plan in large_plans.items() for op in unwanted if op in plan}
    assert found == set()


def read_columns(plan):
    return [set(re.findall(r"(\w+):", found)) for found in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def test_scans_read_only_the_columns_a_query_uses(spark):
    assert read_columns(plan_of(spark, "null_counts_device")) == [
        {"l_partkey", "l_suppkey"}, {"p_partkey"}
    ]
    weekly = read_columns(plan_of(spark, "gold_weekly_admissions"))
    assert {"c_custkey", "c_nationkey"} in weekly and {"n_nationkey"} in weekly
    assert all("o_orderpriority" not in columns for columns in weekly)


def test_claim_filter_reaches_the_orders_before_any_join(large_plans):
    plan = large_plans["gold_rejected_claims"]
    optimized = plan[plan.index("== Optimized Logical Plan"):plan.index("== Physical Plan")]
    assert any("o_orderstatus" in line and "Filter" in line for line in optimized.splitlines())


def test_only_small_results_pass_an_unpartitioned_window(large_plans):
    """One row per claim status."""
    windows = {
        name for name, plan in large_plans.items()
        if "Exchange SinglePartition" in plan and "Window" in plan
    }
    assert windows == {"kpi_claim_distribution"}
    for name in windows:
        physical = large_plans[name][large_plans[name].index("== Physical Plan"):]
        below = physical[physical.index("Exchange SinglePartition"):].splitlines()[1]
        assert "HashAggregate" in below


def physical(plan):
    return plan[plan.index("== Physical Plan"):]


def scans_of(plan):
    """How often each table is scanned, by file name."""
    return Counter(re.findall(rf"{SF}/(\w+)\.parquet", physical(plan)))


def scans_of_sources(spark):
    """The same for a query that does nothing but read the three sources."""
    bound = Bound(spark, SF)
    return sum((scans_of(bound.source(s)._jdf.queryExecution().toString()) for s in SOURCES.values()), Counter())


def test_all_keys_are_checked_by_one_read_of_each_source(spark):
    """The whole job: the query writes nothing and runs nothing before its own plan."""
    runs = len(OPEN_RUNS)
    plan = plan_of(spark, "duplicate_keys")
    assert len(OPEN_RUNS) == runs and scans_of(plan) == scans_of_sources(spark)


def test_hospital_dimensions_take_one_scan_and_one_exchange(spark, tmp_path):
    path = str(tmp_path / "clean")
    Bound(spark, SF).clean("Hospital").write.parquet(path)
    plan = physical(star.hospital_dimensions(spark.read.parquet(path))._jdf.queryExecution().toString())
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1


def test_counts_of_a_run_are_pushed_into_the_footers(spark):
    plan = physical(plan_of(spark, "gold_row_counts"))
    assert plan.count("PushedAggregation: [COUNT(*)]") == 10
    assert f"{SF}/" not in plan


@pytest.mark.parametrize("name", ["audit_log", "audit_by_layer", "audit_run_health", "gold_layer_counts", "layer_reconciliation"])
def test_queries_over_a_run_share_it(spark, name):
    QUERIES["audit_log"](spark, SF)
    runs = len(OPEN_RUNS)
    plan = plan_of(spark, name)
    assert len(OPEN_RUNS) == runs and f"{SF}/" not in physical(plan)


def test_ranks_read_written_tables(spark):
    assert f"{SF}/" not in physical(plan_of(spark, "vw_rejected_claims_ranking"))
