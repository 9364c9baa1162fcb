"""Shape of the physical plans without broadcast joins, as for tables too large for them."""

import re

import pytest

from ordermart.plans.queries import QUERIES

LARGE = ["agg_sales_by_category", "agg_sales_by_seller", "dm_sales_performance", "dm_customer_behavior", "clean_wide", "merge_wide"]


@pytest.fixture(scope="module")
def plan(spark, sf_dir):
    def build(name):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    return build


@pytest.mark.parametrize("name", LARGE)
def test_no_bottleneck_nodes(plan, name):
    text = plan(name)
    for node in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "Python", "BroadcastExchange"):
        assert node not in text, node


def test_incomplete_rows_are_dropped_by_inner_joins(plan):
    text = plan("agg_sales_by_category")
    outer = re.findall(r"SortMergeJoin \[([a-z_]+)#.*LeftOuter", text)
    # Only the translation is optional.
    assert outer == ["product_category_name"]


def test_scans_read_only_the_columns_in_use(plan):
    text = plan("dm_payment_analysis")
    lineitem = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" not in lineitem and "l_quantity" not in lineitem
    assert "IsNotNull(l_partkey)" in lineitem


def test_merge_keeps_left_joins(plan):
    assert "Inner" not in "".join(l for l in plan("merge_wide").splitlines() if "order_id" in l and "SortMergeJoin" in l)


def test_top_customers_sort_no_more_than_ten_per_task(plan):
    assert "TakeOrderedAndProject(limit=10" in plan("top10_customers")


@pytest.mark.parametrize("name", ["star_agg_sales_by_category", "star_agg_sales_by_customer_state"])
def test_fact_rows_are_summed_before_they_meet_a_dimension(plan, name):
    text = plan(name)
    # What is shuffled by the key has been summed below.
    below = text[text.index("SortMergeJoin [") :]
    assert re.search(r"Exchange hashpartitioning\((product|customer)_key#\d+L?, \d+\).*\n.*HashAggregate\(keys=\[(product|customer)_key", below)
