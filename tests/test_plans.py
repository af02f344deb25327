"""Physical checks: pruned scans, pushed filters, no cross joins, no single-task windows."""

import pytest

from millrace.plans import load_all

SF = "/root/testdata/sf0.001"
QUERIES = load_all()


def plan(spark, name):
    return QUERIES[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "daily_sales_by_region", "daily_product_performance", "general_aggregate", "iou_join", "nms", "box_fusion", "match_counts",
    "dq_referential", "dq_orphans", "average_rank", "cumulative_value", "rolling_std_unkeyed", "tfidf_weights", "roc_points",
    "fraud_rapid", "fraud_location", "histogram", "value_distribution", "stratified_split", "class_weights", "impute_mean",
])
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(spark, "daily_sales_by_region")
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text


def test_filters_reach_the_scan(spark):
    assert "GreaterThan(o_orderdate" in plan(spark, "incremental_read")


def test_recent_rows_are_limited_before_the_shuffle(spark):
    text = plan(spark, "recent_n_stats")
    assert text.count("WindowGroupLimit") == 2


def test_text_cleaning_stays_in_one_stage(spark):
    text = plan(spark, "clean_text")
    assert "Python" not in text and "BatchEval" not in text
