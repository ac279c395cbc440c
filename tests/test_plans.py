"""What the physical plans must and must not contain, with joins planned as for large tables."""

import re

import pytest

import __spark_entry__ as registry
from shopperflow.sources.star_schema import StarSchema

# Their plans depend on tables written while they are made; the reports they start from are checked themselves.
MADE_IN_STEPS = {name for name in registry._REPORTS if name.startswith(("churn_model", "churn_proba", "churn_importance", "churn_feature_imp", "kmeans"))}
# A handful of rows: totals of a result that has one row per segment, device, bucket or table.
SMALL_TOTALS = {"segment_distribution", "device_split", "inactivity_buckets"}
# One row per task reaches the last step of a table-wide aggregate.
TABLE_WIDE = {"weekly_report_lines", "bad_cells", "kpi_overview", "weekly_summary", "null_profile", "duplicates_removed"}


@pytest.fixture(scope="module")
def large(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry._REPORTS) - MADE_IN_STEPS))
def test_no_gathering_and_no_cross_joins(large, sf_dir, name):
    plan = plan_of(registry.queries()[name](large, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan
    if name not in SMALL_TOTALS | TABLE_WIDE:
        assert "Exchange SinglePartition, ENSURE_REQUIREMENTS" not in plan
    for line in plan.splitlines():
        if name in TABLE_WIDE and "Exchange SinglePartition" in line:
            after = plan.split(line)[1]
            assert after.lstrip(" +-:*(0123456789)\n").startswith("HashAggregate")


def test_copies_are_reduced_before_the_shuffle(large, sf_dir):
    plan = plan_of(StarSchema(large, sf_dir).single_lines())
    below = plan.split("Exchange hashpartitioning")[1]
    assert "partial_min(struct(" in below


def test_sample_is_reduced_before_the_shuffle(large, sf_dir):
    plan = plan_of(registry.queries()["rfm_scatter_sample"](large, sf_dir))
    assert re.search(r"WindowGroupLimit .* 300, Partial", plan.split("Exchange hashpartitioning")[1])


def test_scans_read_needed_columns_and_filter_early(large, sf_dir):
    tables = StarSchema(large, sf_dir)
    plan = plan_of(registry.queries()["device_split"](large, sf_dir))
    assert "ReadSchema: struct<event_id:bigint>" in plan
    plan = plan_of(tables.transactions().select("customer_id"))
    assert "part.parquet" not in plan
    plan = plan_of(tables.raw_transactions().filter("status = 'Completed'").select("total_amount"))
    assert "PushedFilters" in plan and re.search(r"Filter .*l_returnflag.* = N", plan)


def test_first_purchase_is_an_aggregate_and_a_join(large, sf_dir):
    plan = plan_of(registry.queries()["first_purchase_flag"](large, sf_dir))
    assert "Window" not in plan and "partial_min(struct(order_date" in plan


def test_window_is_chosen_before_copies_are_reduced(large, sf_dir):
    plan = plan_of(registry.queries()["window_scan"](large, sf_dir))
    reduced = plan.index("partial_min(struct(l_shipdate")
    assert "LeftSemi" in plan[reduced:] and "PushedFilters" in plan[reduced:]


def test_orders_are_summed_before_they_are_shuffled_by_customer(large, sf_dir):
    for name in ("churn_status_summary", "spend_tier_by_month", "cohort_ltv", "churn_signals"):
        plan = plan_of(registry.queries()[name](large, sf_dir))
        (below,) = re.findall(r"Exchange hashpartitioning\(customer_id[^\n]*\n([^\n]*partial_sum[^\n]*)", plan)[:1]
        assert "HashAggregate" in below
