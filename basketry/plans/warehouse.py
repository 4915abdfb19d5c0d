"""The layers wired together: every model by name, built lazily from raw tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.merge import newer_than_target
from basketry.operators.quality import Check, run_checks
from basketry.plans import intermediate, marts, staging
from basketry.schemas import TABLES
from basketry.session import ensure_checkpoint_dir

# Shuffle files go when the job that made them ends, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

STAGING = [f"stg_{name}" for name in TABLES]
INTERMEDIATE = [
    "education_types",
    "marital_statuses",
    "order_statuses",
    "payment_methods",
    "brands",
    "locations",
    "addresses",
    "categories_enriched",
    "subcategories_enriched",
    "customers_enriched",
    "products_enriched",
    "reviews_enriched",
    "customer_interactions",
    "order_items",
    "orders",
]
# Views in the serving layer; the facts are tables, laid out by the day given here.
DIMENSIONS = ["dim_categories", "dim_customers", "dim_dates", "dim_locations", "dim_products"]
FACTS: dict[str, str | None] = {
    "fct_customer_activity": "event_date",
    "fct_customer_orders": "order_date",
    "fct_customer_reviews": None,
    "fct_order_details": "order_date",
    "fct_product_interactions": "event_date",
    "fct_product_performance": "date",
    "fct_sales_by_date": None,
    "fct_sales_by_product": "order_date",
    "fct_sales_by_region": "date",
    "customer_journey": None,
}


class Warehouse:
    """Models over raw tables. ``w["orders"]`` composes the plan and runs nothing;
    ``w["raw_orders"]`` is the raw table of that name.

    A model that has been published is read from its table by the models after it, as
    in a layered refresh; otherwise plans compose and Catalyst prunes across layers.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, Callable[[], DataFrame]],
        as_of: date,
        run_ts: datetime,
        mode: str = "faithful",
    ):
        self.spark = spark
        self.raw = raw
        self.as_of = as_of
        self.run_ts = run_ts
        self.mode = mode
        self._built: dict[str, DataFrame] = {}
        self._kept: set[str] = set()  # models that are read from files
        self._shared: set[str] = set()  # models whose readers run in one job

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        w, ts = self, self.run_ts
        if name.startswith("raw_"):
            return self.raw[name.removeprefix("raw_")]()
        if name in STAGING:
            table = name.removeprefix("stg_")
            return staging.stage(self.raw[table](), table)
        builders: dict[str, Callable[[], DataFrame]] = {
            "education_types": lambda: intermediate.education_types(w["stg_customers"], ts),
            "marital_statuses": lambda: intermediate.marital_statuses(w["stg_customers"], ts),
            "order_statuses": lambda: intermediate.order_statuses(w["stg_orders"], ts),
            "payment_methods": lambda: intermediate.payment_methods(w["stg_orders"], ts),
            "brands": lambda: intermediate.brands(w["stg_products"], ts),
            "locations": lambda: intermediate.locations(w["stg_orders"], w["stg_customers"], ts),
            "addresses": lambda: intermediate.addresses(w["stg_orders"], w["stg_customers"], ts),
            "categories_enriched": lambda: intermediate.categories_enriched(
                w["stg_categories"], w["stg_subcategories"], w["stg_products"]
            ),
            "subcategories_enriched": lambda: intermediate.subcategories_enriched(
                w["stg_subcategories"], w["stg_products"]
            ),
            "customers_enriched": lambda: intermediate.customers_enriched(
                w["stg_customers"], w["stg_orders"]
            ),
            "products_enriched": lambda: intermediate.products_enriched(
                w["stg_products"], w["stg_order_items"], w["stg_reviews"]
            ),
            "reviews_enriched": lambda: intermediate.reviews_enriched(
                w["stg_reviews"],
                w["products_enriched"],
                w["categories_enriched"],
                w["subcategories_enriched"],
                w["brands"],
            ),
            "customer_interactions": lambda: intermediate.customer_interactions(
                w["stg_interactions"], w["stg_products"]
            ),
            "order_items": lambda: self._order_items(),
            # not published models: items with what their readers join, added where they lie anyway;
            # kept items are read as they are
            "dated_order_items": lambda: (
                w["order_items"]
                if "order_items" in self._kept
                else self._order_items(days=marts.order_days(w["orders"]))
            ),
            "described_order_items": lambda: (
                w["order_items"]
                if "order_items" in self._kept | self._shared
                else self._order_items(
                    goods=marts.described_goods(
                        w["products_enriched"], w["categories_enriched"], w["brands"]
                    )
                )
            ),
            # not a published model: the texts that addresses are made of
            "street_places": lambda: intermediate.street_places(w["stg_orders"], w["stg_customers"]),
            "orders": lambda: (
                w["orders_with_destination"].drop("shipping_street", "shipping_location_id")
                if "orders_with_destination" in self._kept
                else self._orders()
            ),
            # not a published model: orders with what the address join found on the way
            "orders_with_destination": lambda: self._orders(destination=True),
            "described_orders": lambda: (
                w["orders_with_destination"]
                if "orders_with_destination" in self._kept
                else self._orders(
                    destination=True,
                    people=marts.named_customers(w["customers_enriched"], w["locations"]),
                )
            ),
            "dim_categories": lambda: marts.dim_categories(
                w["categories_enriched"], w["subcategories_enriched"], w["products_enriched"]
            ),
            "dim_customers": lambda: marts.dim_customers(
                w["customers_enriched"],
                w["locations"],
                w["education_types"],
                w["marital_statuses"],
                w["orders"],
                self.as_of,
                ts,
            ),
            "dim_dates": lambda: marts.dim_dates(
                w["stg_orders"], w["customer_interactions"], self.as_of, ts
            ),
            "dim_locations": lambda: marts.dim_locations(w["locations"]),
            "dim_products": lambda: marts.dim_products(
                w["products_enriched"],
                w["categories_enriched"],
                w["subcategories_enriched"],
                w["brands"],
                ts,
            ),
            "fct_customer_activity": lambda: marts.fct_customer_activity(
                w["customers_enriched"], w["customer_interactions"], ts
            ),
            "fct_customer_orders": lambda: marts.fct_customer_orders(
                w["orders"], w["order_items"], w["reviews_enriched"], ts, mode=self.mode
            ),
            "fct_customer_reviews": lambda: marts.fct_customer_reviews(
                w["reviews_enriched"], w["products_enriched"]
            ),
            "fct_order_details": lambda: marts.fct_order_details(
                w["described_orders"],
                w["described_order_items"],
                w["customers_enriched"],
                w["locations"],
                w["products_enriched"],
                w["categories_enriched"],
                w["brands"],
                w["order_statuses"],
                w["payment_methods"],
                w["reviews_enriched"],
                ts,
            ),
            "fct_product_interactions": lambda: marts.fct_product_interactions(
                w["customer_interactions"]
            ),
            "fct_product_performance": lambda: marts.fct_product_performance(
                w["products_enriched"], w["dated_order_items"], w["orders"], ts
            ),
            "fct_sales_by_date": lambda: marts.fct_sales_by_date(w["orders"], ts),
            "fct_sales_by_product": lambda: marts.fct_sales_by_product(
                w["products_enriched"], w["dated_order_items"], w["orders"], ts
            ),
            "fct_sales_by_region": lambda: marts.fct_sales_by_region(
                w["orders"], w["customers_enriched"], ts
            ),
            "customer_journey": lambda: marts.customer_journey(
                w["order_items"], w["orders"], w["categories_enriched"]
            ),
        }
        if name not in builders:
            raise KeyError(f"no model named {name}")
        return builders[name]()

    def _orders(self, destination: bool = False, people: DataFrame | None = None) -> DataFrame:
        return intermediate.orders(
            self["stg_orders"],
            self["stg_order_items"],
            self["stg_reviews"],
            self._address_book(),
            self["stg_customers"],
            self.mode,
            destination,
            people,
        )

    def _address_book(self) -> DataFrame:
        return self["addresses" if "addresses" in self._kept else "street_places"]

    def _order_items(self, **more: DataFrame) -> DataFrame:
        names = ("stg_order_items", "stg_orders", "products_enriched", "stg_reviews")
        return intermediate.order_items(*[self[name] for name in names], **more)

    def customer_orders_since(self, target: DataFrame) -> DataFrame:
        """``fct_customer_orders`` of the orders past the newest ``order_date`` of ``target``.

        New orders come first: their items and reviews are picked by a semi-join before anything
        is aggregated, so the work follows the increment. The address book is that of all orders.
        """
        dated = self["stg_orders"].withColumn("_day", F.to_date("order_date"))
        fresh = newer_than_target(dated, "_day", target, "order_date").drop("_day")
        ids = fresh.select("order_id").distinct()
        items, reviews, enriched = (
            self[name].join(ids, "order_id", "left_semi")
            for name in ("stg_order_items", "stg_reviews", "reviews_enriched")
        )
        orders = intermediate.orders(
            fresh, items, reviews, self._address_book(), self["stg_customers"], self.mode
        )
        bought = intermediate.order_items(items, fresh, self["products_enriched"], reviews)
        return marts.fct_customer_orders(orders, bought, enriched, self.run_ts, mode=self.mode)

    def share(self, names: list[str]) -> None:
        """Say that readers of these models run in one job: all deal their rows out alike, so that
        Spark runs the exchange once."""
        self._shared.update(names)

    # materialization

    def pin(self, models: Mapping[str, list[str]]) -> None:
        """Build the given columns of models once for all later readers, as Parquet in the checkpoint
        folder. What was shuffled for them is removed as soon as they are written, and a small one
        has its size from then on, so that a join need not deal the other side out to learn it."""
        root = f"{ensure_checkpoint_dir(self.spark)}/pinned-{uuid.uuid4().hex}"
        before = self.spark.conf.get(SHUFFLE_CLEANUP, None)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            for name, columns in models.items():
                df = self._build(name).select(*columns)
                df.write.parquet(f"{root}/{name}")
                self._built[name] = self.spark.read.schema(df.schema).parquet(f"{root}/{name}")
                self._kept.add(name)
        finally:
            if before is None:
                self.spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                self.spark.conf.set(SHUFFLE_CLEANUP, before)

    def as_view(self, name: str) -> DataFrame:
        """Register a model as a temporary view; nothing runs."""
        self._built[name] = self._build(name)
        self._built[name].createOrReplaceTempView(name)
        return self.spark.table(name)

    def as_table(
        self, name: str, root: str, day: str | None = None, database: str | None = None
    ) -> DataFrame:
        """Write a model as Parquet under ``root`` and read it back from now on.

        With ``database`` the catalog's table of that name then points at the new files, so
        that other sessions see them; the files of the table before are left where they are.

        A table is never written over: somebody may be reading it.
        Facts are partitioned by day. The rebalance hint groups a day's rows into few
        files and lets AQE split a day that is too large for one task.
        """
        path = f"{root.rstrip('/')}/{name}"
        df = self._build(name)
        if day:
            writer = df.hint("rebalance", day).write.partitionBy(day)
        else:
            writer = df.write
        writer.mode("errorifexists").parquet(path)
        if database:
            qualified = f"{database}.{name}"
            self.spark.sql(f"DROP TABLE IF EXISTS {qualified}")
            self.spark.catalog.createTable(qualified, path=path, source="parquet")
            if day:
                self.spark.catalog.recoverPartitions(qualified)
        # a hidden-folder partition column comes back last: restore the order
        self._built[name] = self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
        self._kept.add(name)
        return self._built[name]

    def refresh(self, root: str, database: str | None = None) -> list[str]:
        """Full refresh into a new folder: staging views, intermediate tables, dimension
        views, fact tables. With ``database`` the catalog has all but the staging views, and
        dimensions are tables as well: a view of another session's plan can't be stored."""
        self._built.clear()
        self._kept.clear()
        for name in STAGING:
            self.as_view(name)
        for name in INTERMEDIATE:
            self.as_table(name, root, database=database)
        for name in DIMENSIONS:
            if database:
                self.as_table(name, root, database=database)
            else:
                self.as_view(name)
        for name, day in FACTS.items():
            self.as_table(name, root, day, database)
        return [*STAGING, *INTERMEDIATE, *DIMENSIONS, *FACTS]

    def check(self, checks: list[Check], prefix: str = "") -> DataFrame:
        """The report of ``run_checks`` on models, or with ``prefix`` "raw_" on raw tables.

        After a refresh it reads the checked columns of the files just written and builds no
        model again; dimensions kept as views are built for their keys only.
        """
        names = {c.table for c in checks} | {c.parent.split(".")[0] for c in checks if c.parent}
        return run_checks({name: self[f"{prefix}{name}"] for name in sorted(names)}, checks)
