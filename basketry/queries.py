"""Every query by name: ``(spark, directory of test tables) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.audit import date_summary, load_audit
from basketry.operators.columns import flatten, normalise_dates, stamp
from basketry.operators.cutover import combine, trim_historic
from basketry.operators.dedup import drop_duplicate_keys
from basketry.operators.ids import (
    fill_missing_key,
    first_missing_ids,
    gap_summary,
    id_gaps,
    key_range,
    lost_ids,
)
from basketry.operators.merge import append_increment, upsert
from basketry.operators.quality import Check
from basketry.operators.sampling import refresh_sampled, sample_keys
from basketry.plans import marts, measures
from basketry.plans.checks import (
    INTERMEDIATE_CHECKS,
    MART_CHECKS,
    RAW_CHECKS,
    STAGING_CHECKS,
)
from basketry.plans.increments import add_load, replace_groups
from basketry.plans.ingest import Run, ingest_table, transform
from basketry.plans.warehouse import Warehouse
from basketry.schemas import TABLES
from basketry.session import RETAIL_CONF, ensure_checkpoint_dir, tune
from basketry.sources.driver_tables import DriverTables
from basketry.sources.versions import Merged, create_table, merge_version, read_version

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 2, 1)
# The order tables end on the first date, the events lie around the second.
ORDERS_AS_OF = date(2001, 8, 1)
EVENTS_AS_OF = date(2024, 1, 15)

# query name -> model name and the audit column that holds the run time
_MODELS: dict[str, tuple[str, str | None]] = {
    **{f"stg_{name}": (f"stg_{name}", None) for name in TABLES},
    "lookup_education": ("education_types", "created_at"),
    "lookup_marital": ("marital_statuses", "created_at"),
    "lookup_status": ("order_statuses", "created_at"),
    "lookup_payment": ("payment_methods", "created_at"),
    "brands": ("brands", "created_at"),
    "locations": ("locations", "created_at"),
    "addresses": ("addresses", "created_at"),
    "categories_enriched": ("categories_enriched", None),
    "subcategories_enriched": ("subcategories_enriched", None),
    "customers_enriched": ("customers_enriched", None),
    "products_enriched": ("products_enriched", None),
    "reviews_enriched": ("reviews_enriched", None),
    "customer_interactions": ("customer_interactions", None),
    "order_items": ("order_items", None),
    "orders_enriched": ("orders", None),
    "dim_categories": ("dim_categories", None),
    "dim_customers": ("dim_customers", "updated_at"),
    "dim_dates": ("dim_dates", "created_at"),
    "dim_locations": ("dim_locations", None),
    "dim_products": ("dim_products", "updated_at"),
    "fct_customer_activity": ("fct_customer_activity", "updated_at"),
    "fct_customer_orders": ("fct_customer_orders", "created_at"),
    "fct_customer_reviews": ("fct_customer_reviews", None),
    "fct_order_details": ("fct_order_details", "updated_at"),
    "fct_product_interactions": ("fct_product_interactions", None),
    "fct_product_performance": ("fct_product_performance", "created_at"),
    "fct_sales_by_date": ("fct_sales_by_date", "updated_at"),
    "fct_sales_by_product": ("fct_sales_by_product", "created_at"),
    "fct_sales_by_region": ("fct_sales_by_region", "created_at"),
    "customer_journey": ("customer_journey", None),
}


def open_warehouse(
    spark: SparkSession, directory: str, as_of: date = ORDERS_AS_OF, mode: str = "faithful"
) -> Warehouse:
    tables = DriverTables(tune(spark, RETAIL_CONF), directory)
    raw = {name: getattr(tables, name) for name in TABLES}
    return Warehouse(spark, raw, as_of, RUN_TS, mode)


def present(df: DataFrame) -> DataFrame:
    """Output types both engines share: bigint counts, double amounts."""
    selected = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        selected.append(column.alias(field.name))
    return df.select(*selected)


def _model(model: str, audit: str | None, as_of: date = ORDERS_AS_OF, mode: str = "faithful") -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        df = open_warehouse(spark, directory, as_of, mode)[model]
        return present(df.drop(audit) if audit else df)

    return run


# Extracts for the ingest queries: the historic one is the whole table, the latest one
# begins at this day and overlaps it.
LATEST_FROM = "2000-01-01"
LATEST_RUN = Run("batch-1", datetime(2001, 8, 3))


def _order_rows(spark: SparkSession, directory: str) -> DataFrame:
    return open_warehouse(spark, directory)["stg_orders"].select(
        "order_id",
        "customer_id",
        "order_date",
        "status",
        "total_amount",
        "data_source",
        "batch_id",
        "loaded_at",
    )


def _latest_orders(spark: SparkSession, directory: str) -> DataFrame:
    """The overlap with pending orders settled, plus the newest month under new ids."""
    recent = _order_rows(spark, directory).filter(
        F.col("order_date") >= F.lit(LATEST_FROM).cast("timestamp_ntz")
    )
    settled = recent.withColumn(
        "status", F.when(F.col("status") == "P", "O").otherwise(F.col("status"))
    )
    added = recent.filter(F.col("order_date") >= F.lit("2001-07-01").cast("timestamp_ntz"))
    added = added.withColumn("order_id", F.concat(F.lit("N"), "order_id"))
    both = settled.unionByName(added)
    return stamp(both, "latest", LATEST_RUN.batch_id, LATEST_RUN.loaded_at)


def ingest_cutover(spark: SparkSession, directory: str) -> DataFrame:
    historic, latest = _order_rows(spark, directory), _latest_orders(spark, directory)
    return present(combine(trim_historic(historic, latest, "order_date"), latest))


def ingest_dedup(spark: SparkSession, directory: str) -> DataFrame:
    items = open_warehouse(spark, directory)["stg_order_items"]
    return present(drop_duplicate_keys(items, "order_item_id", "created_at"))


def ingest_upsert(spark: SparkSession, directory: str) -> DataFrame:
    target, batch = _order_rows(spark, directory), _latest_orders(spark, directory)
    return present(upsert(target, batch, "order_id", "order_date"))


def _merged_twice(spark: SparkSession, directory: str) -> tuple[str, Merged, Merged]:
    """Orders as a table of versions with the latest extract merged in, and merged again."""
    root = f"{ensure_checkpoint_dir(spark)}/orders-{uuid.uuid4().hex}"
    create_table(_order_rows(spark, directory), root, "order_id")
    batch = _latest_orders(spark, directory)
    merges = [merge_version(batch, root, "order_id", "order_date") for _ in range(2)]
    return root, *merges


def ingest_merge_files(spark: SparkSession, directory: str) -> DataFrame:
    root, *_ = _merged_twice(spark, directory)
    return present(read_version(spark, root))


def ingest_merge_counts(spark: SparkSession, directory: str) -> DataFrame:
    """What each version holds, and what the merges that made it changed; the replay changes nothing."""
    root, first, again = _merged_twice(spark, directory)
    sizes = [read_version(spark, root, v).agg(F.lit(v).alias("version"), F.count("*").alias("n_rows")) for v in (1, 2)]
    done = [("merge", 2, first.updated, first.inserted), ("replay", 2, again.updated, again.inserted)]
    changed = spark.createDataFrame(done, "step string, version int, updated long, inserted long")
    return present(sizes[0].unionByName(sizes[1]).join(changed, "version", "left").orderBy("version", "step"))


def ingest_audit(spark: SparkSession, directory: str) -> DataFrame:
    historic, latest = _order_rows(spark, directory), _latest_orders(spark, directory)
    orders = load_audit(
        combine(trim_historic(historic, latest, "order_date"), latest),
        latest,
        "orders",
        "order_id",
        "order_date",
        LATEST_RUN.batch_id,
        LATEST_RUN.loaded_at,
    )
    items = open_warehouse(spark, directory)["stg_order_items"]
    doubled = load_audit(
        items,
        items,
        "order_items",
        "order_item_id",
        "created_at",
        LATEST_RUN.batch_id,
        LATEST_RUN.loaded_at,
    )
    return present(orders.unionByName(doubled).drop("columns", "data_types"))


def ingest_transform(spark: SparkSession, directory: str) -> DataFrame:
    """An extract as it comes: mixed-case and doubled names, NaN, nested columns, spelled dates."""
    orders = DriverTables(tune(spark), directory).read("orders")
    missing = F.col("o_orderkey") % 5 == 0
    extract = orders.select(
        F.col("o_orderkey").cast("string").alias("Order_ID"),
        F.when(missing, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("Total_Amount"),
        F.when(missing, "no date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.struct(F.col("o_orderstatus").alias("code"), F.struct("o_custkey").alias("by")).alias("state"),
        F.col("o_orderpriority").alias("note"),
        F.col("o_orderkey").alias("Note"),
    )
    return transform(extract, "orders", "latest", LATEST_RUN)


def ingest_reference(spark: SparkSession, directory: str) -> DataFrame:
    """A table without history: whatever was there, the latest extract replaces it."""
    categories = open_warehouse(spark, directory)["raw_categories"].select("category_id", "category_name")
    latest = categories.filter(~F.col("category_id").startswith("A")).withColumn(
        "category_name", F.upper("category_name")
    )
    result = ingest_table("categories", categories, latest, LATEST_RUN)
    return result.rows


def incremental_orders(spark: SparkSession, directory: str) -> DataFrame:
    rows = _order_rows(spark, directory).select("order_id", "order_date", "total_amount")
    loaded = rows.filter(F.col("order_date") < F.lit(LATEST_FROM).cast("timestamp_ntz"))
    return present(append_increment(rows, "order_date", loaded))


def incremental_customer_orders(spark: SparkSession, directory: str) -> DataFrame:
    """The mart built up to a day, then extended past its newest date."""
    w = open_warehouse(spark, directory)
    loaded = (
        w["stg_orders"]
        .select(F.to_date("order_date").alias("order_date"))
        .filter(F.col("order_date") < F.lit(LATEST_FROM).cast("date"))
    )
    return present(w.customer_orders_since(loaded).drop("created_at"))


def _loads(rows: DataFrame, day: str, until: str, late: Column) -> list[DataFrame]:
    """A table as it arrives: up to a day but for late rows, then the rest, of all dates."""
    early = F.coalesce((F.col(day) < F.lit(until).cast("timestamp_ntz")) & ~late, F.lit(False))
    return [rows.filter(early), rows.filter(~early)]


def incremental_sales_by_date(spark: SparkSession, directory: str) -> DataFrame:
    """The fact of a first load as a table of versions; the days that a second one touches merged in."""
    root = f"{ensure_checkpoint_dir(spark)}/sales-{uuid.uuid4().hex}"
    orders = open_warehouse(spark, directory)["orders"]
    first, second = _loads(orders, "order_date", LATEST_FROM, F.dayofmonth("order_date") <= 3)
    counts = add_load(spark, f"{root}/state", "fct_sales_by_date", first, "first")
    create_table(marts.finish_sales(counts, RUN_TS), f"{root}/fact", "sale_date")
    counts = add_load(spark, f"{root}/state", "fct_sales_by_date", second, "second")
    merge_version(marts.finish_sales(counts, RUN_TS), f"{root}/fact", "sale_date")
    return present(read_version(spark, f"{root}/fact").drop("updated_at"))


def incremental_customer_activity(spark: SparkSession, directory: str) -> DataFrame:
    """Groups of a first load, those that the late rows touch replaced."""
    w = open_warehouse(spark, directory)
    root = f"{ensure_checkpoint_dir(spark)}/activity-{uuid.uuid4().hex}"
    loads = _loads(w["customer_interactions"], "event_date", "2024-01-10", F.hour("event_date") < 6)
    first = add_load(spark, root, "fct_customer_activity", loads[0], "load0")
    first.write.parquet(f"{root}/first")
    second = add_load(spark, root, "fct_customer_activity", loads[1], "load1")
    days = replace_groups(spark.read.parquet(f"{root}/first"), second, ["customer_id", "event_date"])
    return present(marts.finish_activity(days, w["customers_enriched"], RUN_TS).drop("updated_at"))


def pk_gaps(spark: SparkSession, directory: str) -> DataFrame:
    return present(id_gaps(open_warehouse(spark, directory)["stg_order_items"], "order_id"))


def pk_gap_summary(spark: SparkSession, directory: str) -> DataFrame:
    return present(gap_summary(open_warehouse(spark, directory)["stg_order_items"], "order_id"))


def first_gaps(spark: SparkSession, directory: str) -> DataFrame:
    return present(
        first_missing_ids(open_warehouse(spark, directory)["stg_order_items"], "order_id")
    )


def pk_ranges(spark: SparkSession, directory: str) -> DataFrame:
    """Key range of the historic and the latest side of an ingest."""
    w = open_warehouse(spark, directory)
    ids = w["raw_orders"].select(F.col("order_id").cast("bigint").alias("order_id"), "order_date")
    recent = ids.filter(F.col("order_date") >= F.lit(LATEST_FROM).cast("timestamp_ntz"))
    historic = key_range(ids, "order_id").withColumn("side", F.lit("historic"))
    return present(
        historic.unionByName(key_range(recent, "order_id").withColumn("side", F.lit("latest")))
    )


def lost_order_ids(spark: SparkSession, directory: str) -> DataFrame:
    w = open_warehouse(spark, directory)
    return present(lost_ids(w["stg_orders"], w["stg_order_items"], "order_id"))


def json_flatten(spark: SparkSession, directory: str) -> DataFrame:
    events = DriverTables(tune(spark), directory).read("events")
    nested = events.select(
        "event_id",
        F.from_json("props", "k bigint").alias("props"),
        F.struct("event_type", F.struct("user_id").alias("by")).alias("what"),
        F.array("event_id", "user_id").alias("ids"),
    )
    return present(flatten(nested))


def date_normalise(spark: SparkSession, directory: str) -> DataFrame:
    """The three spellings of the extracts and unreadable text, by event."""
    events = DriverTables(tune(spark), directory).read("events")
    spelled = (
        F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(F.col("event_id") % 4 == 2, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise("not a date")
    )
    return normalise_dates(events.select("event_id", spelled.alias("event_date")))


def key_fill(spark: SparkSession, directory: str) -> DataFrame:
    """Range and density of the key given to extracts that come without one."""
    items = DriverTables(tune(spark), directory).read("lineitem")
    filled = fill_missing_key(items.select("l_orderkey", "l_linenumber"), "id")
    return filled.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("id").alias("distinct_ids"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
    )


def extract_summary(spark: SparkSession, directory: str) -> DataFrame:
    w = open_warehouse(spark, directory)
    tables = {}
    for name, spec in TABLES.items():
        staged = w[f"stg_{name}"]
        day = spec.date_column if spec.date_column in staged.columns else None
        tables[name] = (staged, day)
    return present(date_summary(tables))


def customer_sample(spark: SparkSession, directory: str) -> DataFrame:
    """Exactly 30 % of the customers, the same ones on every run."""
    customers = open_warehouse(spark, directory)["stg_customers"]
    wanted = customers.agg(F.floor(F.count(F.lit(1)) * 0.3)).scalar()
    return present(sample_keys(customers, "customer_id", wanted))


def returning_customers(spark: SparkSession, directory: str) -> DataFrame:
    """A fifth of the customers seen again, joined by the customers of the newest extract."""
    customers = open_warehouse(spark, directory)["stg_customers"]
    fresh = customers.filter(F.col("signup_date") >= F.lit("1995-12-01").cast("timestamp_ntz"))
    fresh = fresh.withColumn("customer_id", F.concat(F.lit("N"), "customer_id"))
    seen_again = {
        "last_login": F.lit(LATEST_RUN.loaded_at).cast("timestamp_ntz"),
        "is_active": F.lit(True),
    }
    return present(refresh_sampled(customers, fresh, "customer_id", 0.2, seen_again))


# What the checked marts join to orders, and orders as most marts read them, built once per report
# with the columns these name.
_PINNED_MARTS = {
    "order_statuses": ["status_id", "status_name"],
    "payment_methods": ["payment_method_id", "method_name"],
    "locations": ["location_id", "city", "state", "country"],
    "orders_with_destination": [
        "order_id",
        "customer_id",
        "order_date",
        "status_id",
        "payment_method_id",
        "shipping_street",
        "shipping_location_id",
        "shipping_cost",
        "total_amount",
        "created_at",
    ]
}
# Every reader of items in the report deals them out by order.
_SHARED_MARTS = ["order_items"]


def _checks(
    checks: list[Check],
    prefix: str = "",
    pinned: dict[str, list[str]] | None = None,
    shared: list[str] | None = None,
) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        w = open_warehouse(spark, directory, EVENTS_AS_OF)
        w.share(shared or [])
        if pinned:
            w.pin(pinned)
        return w.check(checks, prefix)

    return run


def _measure(build: Callable[[Warehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        return present(build(open_warehouse(spark, directory)))

    return run


_MEASURES: dict[str, Callable[[Warehouse], DataFrame]] = {
    "order_status_recency": lambda w: measures.order_status_recency(w["stg_orders"], ORDERS_AS_OF),
    "income_tier": lambda w: measures.income_tiers(w["stg_customers"]),
    "price_band_scores": lambda w: measures.price_band_scores(
        w["stg_reviews"], w["stg_products"], "sale_price"
    ),
    "segment_share": lambda w: measures.segment_share(w["stg_customers"]),
    "new_vs_returning": lambda w: measures.new_vs_returning(w["stg_orders"], 100),
    "event_transitions": lambda w: measures.event_transitions(w["stg_interactions"]),
    "seasonality": lambda w: measures.seasonality(w["stg_orders"], w["stg_interactions"]),
    "review_delay": lambda w: measures.review_delay(w["stg_reviews"], w["stg_orders"], "F"),
    "review_sentiment": lambda w: measures.review_sentiment(w["stg_reviews"]),
    "rating_refresh": lambda w: measures.refresh_ratings(
        w["stg_products"], w["stg_reviews"]
    ).select("product_id", "rating", "review_count"),
}


def registered_queries() -> dict[str, Query]:
    queries = {
        name: _model(model, audit, EVENTS_AS_OF if model == "dim_dates" else ORDERS_AS_OF)
        for name, (model, audit) in _MODELS.items()
    }
    queries["orders_corrected"] = _model("orders", None, mode="corrected")
    for query in (
        ingest_cutover,
        ingest_dedup,
        ingest_upsert,
        ingest_merge_files,
        ingest_merge_counts,
        ingest_audit,
        ingest_transform,
        ingest_reference,
        incremental_orders,
        incremental_customer_orders,
        incremental_sales_by_date,
        incremental_customer_activity,
        pk_gaps,
        pk_gap_summary,
        first_gaps,
        pk_ranges,
        lost_order_ids,
        json_flatten,
        date_normalise,
        key_fill,
        extract_summary,
        customer_sample,
        returning_customers,
    ):
        queries[query.__name__] = query
    queries["dq_report"] = _checks(RAW_CHECKS, "raw_")
    queries["dq_staging"] = _checks(STAGING_CHECKS)
    queries["dq_intermediate"] = _checks(INTERMEDIATE_CHECKS)
    queries["dq_marts"] = _checks(MART_CHECKS, pinned=_PINNED_MARTS, shared=_SHARED_MARTS)
    queries |= {name: _measure(build) for name, build in _MEASURES.items()}
    return queries
