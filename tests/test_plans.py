"""Properties of the physical plans, and invariants between results."""

import re

import pytest
from pyspark.sql import functions as F

from shopscope.catalog import CATALOG
from shopscope.plans import quality, views
from shopscope.plans.lakehouse import Lakehouse

DIRECTORY = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    return Lakehouse.over_testdata(spark, DIRECTORY)


@pytest.mark.parametrize("name", ["gold_order_summary", "gold_customer_360", "gold_customer_category_behavior", "silver_geolocation"])
def test_wide_tables_never_meet_in_one_task(name, lake):
    assert "SinglePartition" not in _plan(CATALOG[name](lake))


def test_scores_have_no_global_window(lake):
    plan = _plan(lake.customer_intelligence)
    assert "Window" not in plan
    # The only single-partition step is the one-row maximum behind the analysis date.
    assert plan.count("SinglePartition") == 1


def test_no_python_workers(lake):
    for name in ("gold_customer_experience", "gold_customer_intelligence", "profile_order_items", "view_customer_segments"):
        assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas", _plan(CATALOG[name](lake)))


def test_foreign_key_rules_are_anti_joins_of_keys(lake):
    for name, rule in quality.RULES.items():
        if isinstance(rule, quality.Orphans):
            plan = _plan(quality.run(name, lake.raw))
            assert "LeftAnti" in plan and "LeftOuter" not in plan and plan.count("HashAggregate") >= 4


def test_scans_read_only_what_is_needed(lake):
    plan = _plan(quality.run("dq_010", lake.raw))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == {"l_orderkey:bigint", "o_orderkey:bigint"}


def test_segments_and_types_partition_the_customers(lake):
    profile = lake.customer_profile
    kpis = lake.executive_kpis.first()
    for view in (views.customer_segments, views.customer_type_performance, views.revenue_concentration):
        rows = view(profile).collect()
        assert sum(r["customers"] for r in rows) == kpis["total_customers"]
        assert sum(r["total_revenue"] for r in rows) == kpis["total_revenue"]
        assert abs(float(sum(r["revenue_percentage"] for r in rows)) - 100) <= 0.03


def test_category_shares_add_up(lake):
    shares = lake.customer_category_behavior.groupBy("customer_unique_id").agg(
        F.sum("category_spend_share").alias("s"), F.count("*").alias("n")
    )
    assert shares.filter("abs(s - 1) > 0.005 * n").count() == 0


def test_scorecard_reads_each_table_twice_at_most(lake):
    """Once for the row conditions, once for the keys; two rules on pairs of columns read one table more."""
    plan = _plan(quality.scorecard(lake.raw))
    single = sum(_plan(df).count("FileScan") for df in (lake.raw[t] for t in lake.raw))
    assert plan.count("FileScan") <= 2 * single + 4


def test_routes_reduce_before_they_meet_sellers(lake):
    plan = _plan(CATALOG["doc_late_rate_by_route"](lake))
    assert re.search(r"Join.*?\n(?:.*\n)*?.*HashAggregate\(keys=\[seller_id", plan)


def test_scorecard_agrees_with_the_rules(lake):
    card = {r["rule_id"]: r for r in quality.scorecard(lake.raw).collect()}
    assert list(card) == sorted(quality.RULES)
    assert card["dq_007"]["violations"] == quality.run("dq_007", lake.raw).first()[0]
    assert card["dq_008"]["violations"] == quality.run("dq_008", lake.raw).count() == 1161
    assert card["dq_001"]["passed"] and not card["dq_010"]["passed"] and card["dq_018"]["passed"] is None
