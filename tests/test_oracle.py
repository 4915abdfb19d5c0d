"""Every registered query against its SQL, and the shape of every plan."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from basketry.queries import registered_queries
from check import compare, oracle_connection
from oracle import oracle_queries
from tests.conftest import SF_DIR

QUERIES = registered_queries()


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    outcome = compare(spark, oracle, name, SF_DIR)
    assert outcome.startswith("ok"), outcome


def test_every_oracle_has_a_query():
    assert set(oracle_queries()) == set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_has_no_pairwise_join_and_no_row_udf(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"BatchEvalPython|ArrowEvalPython", plan)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["review_sentiment"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,R)" in plan
    assert "l_tax" not in plan and "l_extendedprice" not in plan


def test_key_dedup_is_limited_before_the_shuffle(spark):
    plan = plan_of(QUERIES["ingest_dedup"](spark, SF_DIR))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")


def test_name_lists_are_limited_before_the_shuffle(spark):
    assert plan_of(QUERIES["dim_categories"](spark, SF_DIR)).count("WindowGroupLimit") == 4


def test_unused_review_scores_are_not_joined(spark):
    plan = plan_of(QUERIES["fct_sales_by_product"](spark, SF_DIR))
    assert "max_by" not in plan


def joins_on(plan: str, column: str) -> int:
    return len(re.findall(rf"Join \[{column}#\d+\]", plan))


def test_street_text_is_joined_only_where_an_address_is_needed(spark):
    assert "street_address" not in plan_of(QUERIES["dim_dates"](spark, SF_DIR))
    details = plan_of(QUERIES["fct_order_details"](spark, SF_DIR))
    assert joins_on(details, "shipping_address") == joins_on(details, "billing_address") == 1
    assert joins_on(details, "shipping_address_id") == 0


def test_increment_reduces_items_and_reviews_before_they_are_aggregated(spark):
    plan = QUERIES["incremental_customer_orders"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    depth = [len(re.match(r"[\s:]*(?:\+-)?", line).group()) for line in lines]
    semi = [k for k, line in enumerate(lines) if "LeftSemi" in line]
    assert len(semi) == 2  # items and reviews; what orders hold of them is not asked for
    for k in semi:  # the nearest node above that stands on this one is an aggregate, sooner or later
        above, level = [], depth[k]
        for j in range(k - 1, -1, -1):
            if depth[j] < level:
                above.append(lines[j])
                level = depth[j]
        assert any("Aggregate" in line for line in above)
