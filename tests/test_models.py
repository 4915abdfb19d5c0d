"""Model behaviour on hand-made rows: quirks, NULLs, ties, fan-out."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from basketry.plans import intermediate, marts, measures
from basketry.plans.checks import INTERMEDIATE_CHECKS
from basketry.plans.warehouse import FACTS, INTERMEDIATE, Warehouse
from tests import fixtures as fx
from tests.conftest import rows


def two_by_two(spark, mode):
    return fx.warehouse(
        spark,
        mode,
        customers=[fx.customer("c1")],
        products=[fx.product("p1"), fx.product("p2")],
        categories=[fx.CATEGORY],
        subcategories=[fx.SUBCATEGORY],
        orders=[fx.order("o1")],
        order_items=[fx.item("i1", product_id="p1", quantity=1), fx.item("i2", product_id="p2", quantity=2)],
        reviews=[fx.review("r1", product_id="p1", score=5), fx.review("r2", product_id="p2", score=2)],
    )


@pytest.mark.parametrize("mode,items", [("faithful", 6), ("corrected", 3)])
def test_item_totals_and_reviews(spark, mode, items):
    w = two_by_two(spark, mode)
    row = w["orders"].first()
    assert (row.unique_products, row.total_items, row.has_review) == (2, items, True)
    assert row.avg_review_score == 3.5
    fact = w["fct_customer_orders"].first()
    assert (fact.unique_products, fact.total_items, fact.avg_order_value) == (2, items, 50.0)


def test_modes_agree_with_at_most_one_review(spark):
    tables = dict(
        customers=[fx.customer("c1")],
        products=[fx.product("p1")],
        orders=[fx.order("o1"), fx.order("o2")],
        order_items=[fx.item("i1", quantity=4), fx.item("i2", "o2", quantity=3)],
        reviews=[fx.review("r1")],
    )
    faithful = fx.warehouse(spark, "faithful", **tables)["orders"]
    assert rows(faithful) == rows(fx.warehouse(spark, "corrected", **tables)["orders"])
    by_id = {r.order_id: r for r in faithful.collect()}
    assert by_id["o2"].has_review is False and by_id["o2"].avg_review_score is None


def test_order_without_items(spark):
    row = fx.warehouse(spark, customers=[fx.customer("c1")], orders=[fx.order("o1")])["orders"].first()
    assert (row.unique_products, row.total_items, row.has_review) == (0, None, False)


def test_copied_order_rows_count_twice_in_faithful_mode(spark):
    w = fx.warehouse(
        spark,
        customers=[fx.customer("c1")],
        orders=[fx.order("o1"), fx.order("o1")],
        order_items=[fx.item("i1", quantity=4)],
    )
    assert [r.total_items for r in w["orders"].collect()] == [8]


def test_street_in_two_cities_doubles_the_order(spark):
    tables = dict(
        customers=[fx.customer("c1"), fx.customer("c2", city="Boston", state="MA")],
        orders=[
            fx.order("o1", "c1", shipping_address="1 High St", billing_address=None),
            fx.order("o2", "c2", shipping_address="1 High St", billing_address=None),
        ],
    )
    faithful = fx.warehouse(spark, **tables)
    assert faithful["addresses"].count() == 2
    assert faithful["orders"].groupBy("order_id").count().agg(F.min("count")).first()[0] == 2
    assert faithful["fct_sales_by_date"].first().total_revenue == 400
    assert fx.warehouse(spark, "corrected", **tables)["orders"].count() == 2


def test_locations_from_address_parts(spark):
    streets = ["12 Main St", "1 A St, Austin, Texas, USA", " , , ", None]
    w = fx.warehouse(
        spark,
        customers=[fx.customer("c1", city=" Reno ", state="NV"), fx.customer("c2", city=" ")],
        orders=[
            fx.order(f"o{i}", shipping_address=s, billing_address=None) for i, s in enumerate(streets)
        ],
    )
    got = {(r.city, r.state, r.country) for r in w["locations"].collect()}
    assert got == {("Austin", "Texas", "USA"), ("Reno", "NV", "USA")}
    # customers without a complete location are left out of the enriched table
    assert [r.customer_id for r in w["customers_enriched"].collect()] == ["c1"]
    assert w["dim_customers"].first().city == "Reno"


def test_address_of_a_customer_without_city_keeps_a_key(spark):
    w = fx.warehouse(spark, customers=[fx.customer("c1", city=None)], orders=[fx.order("o1")])
    row = w["addresses"].first()
    assert len(row.location_id) == 32 and w["locations"].count() == 0


def test_blank_brands(spark):
    brands = ["Acme", " Acme ", "", "  ", None]
    w = fx.warehouse(
        spark, products=[fx.product(f"p{i}", brand=b) for i, b in enumerate(brands)]
    )
    assert [r.brand_name for r in w["brands"].collect()] == ["Acme"]
    keys = {r.product_id: r.brand_id for r in w["products_enriched"].collect()}
    assert keys["p0"] == keys["p1"] == w["brands"].first().brand_id
    assert keys["p2"] is keys["p3"] is keys["p4"] is None


def test_unknown_lookup_values_have_no_key(spark):
    w = fx.warehouse(spark, customers=[fx.customer("c1", education=None, marital_status="Single")])
    row = w["customers_enriched"].first()
    assert row.education_id is None
    assert row.marital_status_id == w["marital_statuses"].first().marital_status_id
    assert w["education_types"].count() == 0


def test_category_without_anything(spark):
    w = fx.warehouse(
        spark,
        categories=[fx.CATEGORY, {"category_id": "k2", "category_name": "Empty"}],
        subcategories=[fx.SUBCATEGORY],
        products=[fx.product("p1"), fx.product("p2", product_name=None, category_id="k3")],
    )
    counts = {r.category_id: (r.subcategory_count, r.product_count) for r in w["categories_enriched"].collect()}
    assert counts == {"k1": (1, 1), "k2": (0, 0)}
    lists = {r.category_id: (r.subcategories, r.product_names) for r in w["dim_categories"].collect()}
    assert lists == {"k1": ("Blocks", "name p1"), "k2": ("", None)}


def test_name_list_is_cut_exactly(spark):
    names = [""] + [chr(97 + i // 26 % 26) + chr(97 + i % 26) for i in range(600)]
    df = spark.createDataFrame([("g", n) for n in names] + [("n", None)], "g string, name string")
    got = {r.g: r.names for r in marts.name_list(df, ["g"], "name", "names").collect()}
    assert got == {"g": ", ".join(sorted(names))[:1000], "n": ""}
    letters = spark.createDataFrame([("g", chr(200 + i)) for i in range(500)], "g string, name string")
    got = marts.name_list(letters, ["g"], "name", "names").first().names
    assert got == ", ".join(chr(200 + i) for i in range(500))[:1000]


def test_items_take_the_newest_review(spark):
    w = fx.warehouse(
        spark,
        customers=[fx.customer("c1")],
        products=[fx.product("p1"), fx.product("p2"), fx.product("p3")],
        orders=[fx.order("o1")],
        order_items=[
            fx.item("i1", product_id="p1"),
            fx.item("i1", product_id="p1"),  # an exact copy
            fx.item("i2", product_id="p2"),
            fx.item("i3", product_id="p3"),
            fx.item("i4", product_id="gone"),
            fx.item("i5", product_id=None),
        ],
        reviews=[
            fx.review("r1", product_id="p1", score=1, loaded_at="2024-01-01"),
            fx.review("r2", product_id="p1", score=4, loaded_at="2024-01-02"),
            fx.review("r3", product_id="p2", score=2, loaded_at="2024-01-02"),
            fx.review("r4", product_id="p2", score=3, loaded_at=None),
            fx.review("r5", product_id="p3", score=5, loaded_at="2024-01-02"),
            fx.review("r6", product_id="p3", score=None, loaded_at="2024-01-03"),
        ],
    )
    got = {r.order_item_id: r.review_score for r in w["order_items"].collect()}
    assert got == {"i1": 4, "i2": 3, "i3": None}
    assert w["order_items"].count() == 3


@pytest.mark.parametrize(
    "last,status",
    [
        (date(2024, 5, 1), "Active"),
        (date(2024, 4, 30), "At Risk"),
        (date(2024, 2, 1), "At Risk"),
        (date(2024, 1, 31), "Churned"),
        (None, "Churned"),
    ],
)
def test_customer_status(spark, last, status):
    w = fx.warehouse(
        spark,
        as_of=date(2024, 8, 1),
        customers=[fx.customer("c1", signup_date="2024-07-01 23:00:00")],
        orders=[fx.order("o1", order_date=last.isoformat())] if last else [],
    )
    row = w["dim_customers"].first()
    assert row.customer_status == status
    assert row.customer_lifetime_days == ((date(2024, 8, 1) - last).days if last else 31)


def test_stock_levels(spark):
    stock = {"p0": "0", "p1": "9", "p2": "10", "p3": None}
    w = fx.warehouse(spark, products=[fx.product(p, stock_quantity=s) for p, s in stock.items()])
    got = {r.product_id: (r.inventory_status, r.avg_review_score) for r in w["dim_products"].collect()}
    assert got == {
        "p0": ("Out of Stock", 0.0),
        "p1": ("Low Stock", 0.0),
        "p2": ("In Stock", 0.0),
        "p3": ("In Stock", 0.0),
    }


def test_trailing_window_counts_rows_not_days(spark):
    days = [date(2023, 1, 1) + timedelta(days=3 * i) for i in range(40)]
    quantities = [100] * 9 + [1] * 31
    w = fx.warehouse(
        spark,
        customers=[fx.customer("c1")],
        products=[fx.product("p1", stock_quantity="12", base_price="6.00")],
        orders=[fx.order(f"o{i}", order_date=d.isoformat()) for i, d in enumerate(days)],
        order_items=[fx.item(f"i{i}", f"o{i}", quantity=q) for i, q in enumerate(quantities)],
    )
    got = w["fct_product_performance"].orderBy("date").collect()
    # the last day sees 31 rows of 1 unit: 7 < 10, and stock 12 is above; the day before sees a 100
    assert [r.reorder_flag for r in got][-2:] == [True, False]
    assert str(got[0].profit_margin) == "40.00"


def test_reorder_flag_is_false_without_quantity(spark):
    w = fx.warehouse(
        spark,
        customers=[fx.customer("c1")],
        products=[fx.product("p1", stock_quantity="1")],
        orders=[fx.order("o1")],
        order_items=[fx.item("i1", quantity=None)],
    )
    row = w["fct_product_performance"].first()
    assert (row.units_sold, row.reorder_flag) == (None, False)


def test_undated_events_and_unknown_customers_are_left_out(spark):
    w = fx.warehouse(
        spark,
        customers=[fx.customer("c1")],
        interactions=[
            {"event_id": "1", "customer_id": "c1", "event_type": "view", "event_date": "2024-01-01"},
            {"event_id": "2", "customer_id": "c1", "event_type": "view", "event_date": "bad"},
            {"event_id": "3", "customer_id": "cX", "event_type": "view", "event_date": "2024-01-01"},
            {"event_id": "4", "customer_id": None, "event_type": "view", "event_date": "2024-01-01"},
        ],
    )
    row = w["fct_customer_activity"].collect()
    assert [(r.total_views, r.unique_products_viewed, r.total_sessions) for r in row] == [(1, 0, 0)]


def test_incremental_equals_full_refresh(spark):
    w = two_by_two(spark, "faithful")
    more = dict(
        customers=[fx.customer("c1")],
        products=[fx.product("p1")],
        orders=[fx.order("o1"), fx.order("o2", order_date="2024-01-20 08:00:00")],
        order_items=[fx.item("i1"), fx.item("i2", "o2")],
        reviews=[fx.review("r1", loaded_at="2024-01-11"), fx.review("r2", "o2", loaded_at="2024-01-21")],
    )
    w = fx.warehouse(spark, **more)
    full = w["fct_customer_orders"]
    loaded = full.filter("order_id = 'o1'")
    fresh = marts.fct_customer_orders(
        w["orders"], w["order_items"], w["reviews_enriched"], fx.RUN_TS, target=loaded
    )
    assert [r.order_id for r in fresh.collect()] == ["o2"]
    assert rows(loaded.unionByName(fresh)) == rows(full)
    seen = w["reviews_enriched"].filter("review_id = 'r1'")
    newer = marts.fct_customer_reviews(w["reviews_enriched"], w["products_enriched"], target=seen)
    assert [(r.order_id, r.created_at) for r in newer.collect()] == [("o2", datetime(2024, 1, 21))]


def test_published_layers_give_the_same_marts(spark, tmp_path):
    w = two_by_two(spark, "faithful")
    expected = {name: rows(w[name]) for name in FACTS}
    built = two_by_two(spark, "faithful")
    names = built.refresh(str(tmp_path / "one"))
    assert set(INTERMEDIATE) <= set(names)
    assert {name: rows(built[name]) for name in FACTS} == expected
    assert (tmp_path / "one" / "fct_order_details" / "order_date=2024-01-10").exists()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        built.refresh(str(tmp_path / "one"))
    built.refresh(str(tmp_path / "two"))
    assert {name: rows(built[name]) for name in FACTS} == expected
    assert spark.table("dim_products").count() == 2


def copied_rows(spark):
    """Copies of a customer, a product, an item and an order; a street in two cities, one unknown customer."""
    return fx.warehouse(
        spark,
        customers=[fx.customer("c1"), fx.customer("c1"), fx.customer("c2", city="Boston", state="MA")],
        products=[fx.product("p1"), fx.product("p1"), fx.product("p2")],
        categories=[fx.CATEGORY],
        subcategories=[fx.SUBCATEGORY],
        orders=[
            fx.order("o1", shipping_address="1 High St"),
            fx.order("o1", shipping_address="1 High St"),
            fx.order("o2", "c2", shipping_address="1 High St", billing_address=None),
            fx.order("o3", "gone"),
        ],
        order_items=[
            *[fx.item("i1")] * 3,
            fx.item("i2", "o2", "p2"),
            fx.item("i3", "o3"),
            fx.item("i4", "o4"),
            fx.item("i5", product_id=None),
        ],
        reviews=[fx.review("r1"), fx.review("r2")],
    )


def test_copies_multiply_the_facts_alike_composed_and_published(spark, tmp_path):
    w = copied_rows(spark)
    details = rows(w["fct_order_details"].groupBy("order_id", "product_id", "shipping_city").count())
    # o1: two copies of the customer and of the product, two reviews of a product with two rows
    assert details == [
        ("o1", "p1", "Austin", 16),
        ("o1", "p1", "Boston", 16),
        ("o2", "p2", "Austin", 1),
        ("o2", "p2", "Boston", 1),
    ]
    assert {r.total_orders for r in w["fct_sales_by_product"].collect()} == {1, 2}
    expected = {name: rows(w[name]) for name in FACTS}
    built = copied_rows(spark)
    built.refresh(str(tmp_path))
    assert {name: rows(built[name]) for name in FACTS} == expected


def test_checks_after_a_refresh_read_the_written_files_once(spark, tmp_path):
    composed = rows(two_by_two(spark, "faithful").check(INTERMEDIATE_CHECKS))
    built = two_by_two(spark, "faithful")
    built.refresh(str(tmp_path))
    report = built.check(INTERMEDIATE_CHECKS)
    assert rows(report) == composed
    names = {c.table for c in INTERMEDIATE_CHECKS} | {c.parent.split(".")[0] for c in INTERMEDIATE_CHECKS if c.parent}
    plan = report._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == len(names)
    assert all(str(tmp_path) in path for path in report.inputFiles())
    assert "total_amount" not in plan and "product_name" not in plan


def test_unknown_model():
    with pytest.raises(KeyError):
        Warehouse(None, {}, fx.AS_OF, fx.RUN_TS)["nothing"]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        intermediate.orders(None, None, None, None, None, "other")


def test_ratings(spark):
    w = fx.warehouse(
        spark,
        products=[fx.product("p1", rating="3.0", review_count="9"), fx.product("p2", rating="3.0", review_count="9")],
        reviews=[fx.review(f"r{i}", score=s) for i, s in enumerate([5, 4, 4, 4])],
    )
    got = {
        r.product_id: (float(r.rating), r.review_count)
        for r in measures.refresh_ratings(w["stg_products"], w["stg_reviews"]).collect()
    }
    assert got == {"p1": (4.3, 4), "p2": (3.0, 9)}


def test_status_from_age(spark):
    df = spark.createDataFrame([(date(2024, 1, 10) - timedelta(days=d),) for d in (0, 1, 2, 3, 4, 6, 7, 90)], "d date")
    got = [r[0] for r in df.select(measures.status_from_age(F.col("d"), date(2024, 1, 10))).collect()]
    assert got == ["Pending"] * 2 + ["Processing"] * 2 + ["Shipped"] * 2 + ["Delivered"] * 2
