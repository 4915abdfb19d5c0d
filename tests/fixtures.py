"""Small hand-made raw tables for paths the generated data cannot reach."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from basketry.plans.warehouse import Warehouse
from basketry.schemas import TABLES

RUN_TS = datetime(2024, 2, 1)
AS_OF = date(2024, 2, 1)
LOADED = "2024-01-31 00:00:00"


def raw(spark: SparkSession, table: str, records: list[dict]) -> DataFrame:
    """Raw rows as text, the way a text extract arrives; absent columns are NULL."""
    names = list(TABLES[table].staged)
    defaults = {"data_source": "historic", "batch_id": "b0", "loaded_at": LOADED}
    values = []
    for record in records:
        unknown = set(record) - set(names)
        assert not unknown, unknown
        merged = {**defaults, **record}
        values.append(
            tuple(None if merged.get(n) is None else str(merged[n]) for n in names)
        )
    return spark.createDataFrame(values, ", ".join(f"{n} string" for n in names))


def warehouse(spark: SparkSession, mode: str = "faithful", as_of: date = AS_OF, **tables) -> Warehouse:
    loaders = {}
    for name in TABLES:
        df = raw(spark, name, tables.get(name, []))
        loaders[name] = lambda df=df: df
    return Warehouse(spark, loaders, as_of, RUN_TS, mode)


def customer(customer_id, city="Austin", state="Texas", country="USA", **more) -> dict:
    base = {
        "customer_id": customer_id,
        "email": f"{customer_id}@x.com",
        "city": city,
        "state": state,
        "country": country,
        "signup_date": "2023-01-01",
    }
    return {**base, **more}


def order(order_id, customer_id="c1", order_date="2024-01-10", **more) -> dict:
    base = {
        "order_id": order_id,
        "customer_id": customer_id,
        "order_date": order_date,
        "status": "Delivered",
        "total_amount": "100.00",
        "shipping_cost": "5.00",
        "payment_method": "PayPal",
        "shipping_address": f"{order_id} Main St",
        "billing_address": f"{order_id} Main St",
    }
    return {**base, **more}


def item(order_item_id, order_id="o1", product_id="p1", quantity=1, price="10.00", **more) -> dict:
    base = {
        "order_item_id": order_item_id,
        "order_id": order_id,
        "product_id": product_id,
        "quantity": quantity,
        "unit_price": price,
        "total_price": f"{float(price) * (quantity or 0):.2f}",
    }
    return {**base, **more}


def product(product_id, **more) -> dict:
    base = {
        "product_id": product_id,
        "category_id": "k1",
        "subcategory_id": "s1",
        "product_name": f"name {product_id}",
        "base_price": "6.00",
        "stock_quantity": "20",
        "brand": "Acme",
    }
    return {**base, **more}


def review(review_id, order_id="o1", product_id="p1", score=5, **more) -> dict:
    base = {
        "review_id": review_id,
        "order_id": order_id,
        "product_id": product_id,
        "customer_id": "c1",
        "review_score": score,
    }
    return {**base, **more}


CATEGORY = {"category_id": "k1", "category_name": "Toys"}
SUBCATEGORY = {"subcategory_id": "s1", "category_id": "k1", "subcategory_name": "Blocks"}
