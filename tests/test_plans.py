"""Plan guards: properties of the physical plans that matter at scale."""

import re

import pytest

from conftest import SF_SMALL
from tidemart.plans.registry import QUERIES
from tidemart.sources import fixtures as fx
from tidemart.operators import logsplit
from tidemart.plans import log as logplans
from tidemart.streaming import jobs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_products(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_log_lines_are_parsed_once(spark):
    clean, _ = logsplit.parse(fx.raw_log(spark, SF_SMALL))
    assert plan_of(clean).count("from_json") == 1


def test_cdc_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["tool_coupon_order"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_linestatus), EqualTo(l_returnflag,N)" in plan
    # only the columns the job needs are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," in plan
    assert "l_extendedprice" not in plan.split("ReadSchema: struct<l_orderkey")[1].split(">")[0]


def test_unique_new_window_reuses_the_detail_shuffle(spark):
    df = QUERIES["dws_trade_order"](spark, SF_SMALL)
    df.collect()
    assert "Reused" in plan_of(df)


def test_bounce_is_one_window_without_a_join(spark):
    plan = plan_of(logplans.user_jump_detail(spark.createDataFrame([], jobs.FLAT_PAGE_SCHEMA)))
    assert plan.count("+- Window ") == 1 and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.fixture
def small_broadcasts(spark):
    """Fact tables don't fit a broadcast, the dictionary does, as at scale."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "4000")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", ["trade_order_pre_process", "trade_order_detail", "trade_cancel_detail", "trade_pay_detail_suc",
                                  "trade_pay_detail_suc_success_only", "dws_trade_order", "dws_trade_payment", "dws_trade_sku_order",
                                  "trade_order_refund", "trade_refund_pay_suc", "trade_cart_add", "interaction_comment"])
def test_lookups_shuffle_nothing_by_the_few_codes(spark, small_broadcasts, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert not re.findall(r"Exchange hashpartitioning\((?:source_type|payment_type|refund_type|refund_reason_type|appraise)\w*#", plan)


@pytest.mark.parametrize("name", ["trade_order_pre_process", "trade_order_detail", "trade_cancel_detail", "trade_pay_detail_suc",
                                  "trade_pay_detail_suc_success_only"])
def test_order_lines_are_shuffled_once_by_detail_id(spark, small_broadcasts, name):
    # Lines come partitioned by the order; the latest version needs no further exchange by id.
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert not re.findall(r"Exchange hashpartitioning\(order_(?:detail_)?id#", plan)
    assert len(re.findall(r"Exchange hashpartitioning\(id#", plan)) == 1
