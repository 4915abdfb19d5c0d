"""Queries on skewed and dirty tables, planned as for tables too large to broadcast.

A third of the orders belong to one customer, a third of the items to one product, a
third of the events to one session; one item occurs a thousand times over, and keys,
names and brands are missing or blank here and there.
"""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as entry
from basketry import session
from check import compare, oracle_connection
from tests.conftest import SF_DIR

_TABLES = {
    "region": "SELECT * FROM src",
    "nation": "SELECT * FROM src",
    "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 9 = 4 THEN NULL ELSE c_mktsegment END "
    "AS c_mktsegment) FROM src",
    "part": "SELECT * REPLACE (CASE p_partkey % 7 WHEN 1 THEN '  ' WHEN 2 THEN NULL WHEN 3 THEN "
    "' ' || p_brand || ' ' ELSE p_brand END AS p_brand, "
    "CASE WHEN p_partkey % 11 = 5 THEN NULL ELSE p_name END AS p_name, "
    "CASE WHEN p_partkey % 13 = 6 THEN NULL ELSE p_size END AS p_size) FROM src",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 17 = 1 THEN NULL "
    "WHEN o_orderkey % 19 = 1 THEN 999999 ELSE o_custkey END AS o_custkey, "
    "CASE WHEN o_orderkey % 23 = 2 THEN NULL ELSE o_orderdate END AS o_orderdate, "
    "CASE WHEN o_orderkey % 29 = 3 THEN NULL ELSE o_orderpriority END AS o_orderpriority) FROM src "
    "UNION ALL SELECT * FROM src WHERE o_orderkey % 101 = 7",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 1 THEN 7 WHEN l_orderkey % 31 = 2 THEN NULL "
    "WHEN l_orderkey % 37 = 3 THEN 888888 ELSE l_partkey END AS l_partkey) FROM src "
    "UNION ALL SELECT c.* FROM (SELECT * FROM src ORDER BY l_orderkey, l_partkey, l_linenumber "
    "LIMIT 1) AS c, range(1000)",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 3 WHEN event_id % 41 = 1 THEN NULL "
    "ELSE user_id END AS user_id, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05 06:00:00' "
    "ELSE ts END AS ts, CASE WHEN event_id % 43 = 2 THEN '{}' ELSE props END AS props) FROM src",
}

_QUERIES = [
    "stg_products",
    "lookup_education",
    "brands",
    "locations",
    "addresses",
    "categories_enriched",
    "customers_enriched",
    "products_enriched",
    "reviews_enriched",
    "customer_interactions",
    "order_items",
    "orders_enriched",
    "dim_categories",
    "dim_customers",
    "dim_dates",
    "fct_customer_activity",
    "fct_customer_orders",
    "fct_customer_reviews",
    "fct_order_details",
    "fct_product_interactions",
    "fct_product_performance",
    "fct_sales_by_date",
    "fct_sales_by_product",
    "fct_sales_by_region",
    "customer_journey",
    "ingest_audit",
    "pk_gaps",
    "event_transitions",
    "price_band_scores",
    "rating_refresh",
    "dq_report",
]

_LARGE_PLAN = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    directory = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name, sql in _TABLES.items():
        con.execute(f"CREATE OR REPLACE VIEW src AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
        con.execute(f"COPY ({sql}) TO '{directory}/{name}.parquet' (FORMAT parquet)")
    return str(directory)


@pytest.fixture(scope="module")
def oracle(skewed):
    return oracle_connection(skewed)


@pytest.fixture
def large_plan(spark, monkeypatch):
    before = {key: spark.conf.get(key, None) for key in _LARGE_PLAN}
    monkeypatch.setattr(session, "RUNTIME_CONF", session.RUNTIME_CONF | _LARGE_PLAN)
    session.tune(spark)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize("name", _QUERIES)
def test_skewed_tables(spark, large_plan, oracle, skewed, name):
    outcome = compare(spark, oracle, name, skewed)
    assert outcome.startswith("ok"), outcome


def test_hot_join_partitions_are_split(spark, large_plan, skewed):
    df = entry.queries()["fct_sales_by_region"](spark, skewed)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_items_meet_orders_and_reviews_where_they_lie(spark, large_plan, skewed):
    """Items are dealt by their row, by order and by product, and reviews not met by a deal of their own."""
    df = entry.queries()["order_items"](spark, skewed)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, product_id#\d+", plan)) == 1


def test_items_are_dealt_out_by_one_column(spark, large_plan, skewed):
    """Not by their whole row to make them distinct, and again by the key of their first join."""
    for name in ("order_items", "fct_order_details"):
        plan = entry.queries()[name](spark, skewed)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(order_item_id#" not in plan


def test_order_details_group_orders_where_they_meet_customers(spark, large_plan, skewed):
    df = entry.queries()["fct_order_details"](spark, skewed)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(order_id#\d+, customer_id#\d+, order_date", plan)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(billing_address#" in line]
    assert dealt and "address_id" not in plan.split("Exchange hashpartitioning(billing_address#")[1].split("Exchange")[0]


def test_sold_items_lie_by_product_when_they_are_grouped(spark, large_plan, skewed):
    df = entry.queries()["fct_sales_by_product"](spark, skewed)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(product_id#\d+, date#", plan)


def test_checks_of_the_marts_build_orders_once(spark, large_plan, skewed):
    """They read them from Parquet, with the columns asked for; grain keys are not dealt out as hashes."""
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    report = entry.queries()["dq_marts"](spark, skewed)
    assert spark.conf.get(cleanup, None) == before
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shipping_address#" not in plan and "ExistingRDD" not in plan


def test_checks_of_the_marts_on_skewed_tables(spark, large_plan, oracle, skewed):
    outcome = compare(spark, oracle, "dq_marts", skewed)
    assert outcome.startswith("ok"), outcome
