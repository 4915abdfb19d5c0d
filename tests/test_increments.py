"""Facts extended load by load equal the same fact built at once."""

from __future__ import annotations

import random
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.operators.distinct_counts import grouped_distinct_counts
from basketry.plans.increments import COUNTED_FACTS, add_load, replace_groups
from tests.conftest import rows

ORDERS = "order_id string, customer_id string, order_date timestamp, total_amount decimal(12,2), shipping_cost decimal(12,2)"
EVENTS = "customer_id string, event_date timestamp, event_type string, product_id string, session_id string, device_type string"


def orders(spark, n, seed):
    rng = random.Random(seed)
    made = [
        (
            f"o{rng.randrange(n)}",  # some orders twice, as the address fan-out leaves them
            rng.choice(["a", "b", "c", "d", None]),
            rng.choice([None, *(datetime(2024, 1, day, 5) for day in range(1, 9))]),
            rng.choice([None, Decimal(10), Decimal(20)]),
            rng.choice([None, Decimal(1)]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(made, ORDERS)


def events(spark, n, seed):
    rng = random.Random(seed)
    made = [
        (
            rng.choice(["a", "b", None]),
            rng.choice([None, *(datetime(2024, 1, day, 5) for day in range(1, 5))]),
            rng.choice(["view", "cart_add", "purchase", None]),
            f"p{rng.randrange(4)}",
            f"s{rng.randrange(5)}",
            rng.choice(["phone", "desk", None]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(made, EVENTS)


@pytest.mark.parametrize("name, make", [("fct_sales_by_date", orders), ("fct_customer_activity", events)])
def test_loads_equal_one_build(spark, tmp_path, name, make):
    fact = COUNTED_FACTS[name]
    by, distinct, sums = fact.counts()
    built = sofar = None
    for k, size in enumerate((60, 25, 1)):  # later loads hold earlier days as well
        load = make(spark, size, k)
        fresh = add_load(spark, str(tmp_path), name, load, f"l{k}")
        built = fresh if built is None else replace_groups(built, fresh, by)
        sofar = load if sofar is None else sofar.unionByName(load)
        whole = grouped_distinct_counts(fact.rows(sofar), by, distinct, sums)
        assert rows(built.select(*whole.columns)) == rows(whole)


def test_a_load_finishes_only_its_groups(spark, tmp_path):
    first = orders(spark, 80, 1)
    add_load(spark, str(tmp_path), "fct_sales_by_date", first, "l0")
    late = first.where("order_date = timestamp '2024-01-03 05:00:00'").withColumn("order_id", F.lit("late")).limit(2)
    fresh = add_load(spark, str(tmp_path), "fct_sales_by_date", late, "l1")
    assert [r["sale_date"] for r in fresh.collect()] == [date(2024, 1, 3)]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*sale_date", plan)  # state of other days is not read


def test_a_repeated_load_changes_nothing(spark, tmp_path):
    load = orders(spark, 40, 2)
    once = rows(add_load(spark, str(tmp_path), "fct_sales_by_date", load, "l0"))
    assert rows(add_load(spark, str(tmp_path), "fct_sales_by_date", load, "l0")) == once


def test_an_empty_load_touches_nothing(spark, tmp_path):
    add_load(spark, str(tmp_path), "fct_sales_by_date", orders(spark, 10, 3), "l0")
    assert add_load(spark, str(tmp_path), "fct_sales_by_date", orders(spark, 0, 0), "l1").count() == 0
