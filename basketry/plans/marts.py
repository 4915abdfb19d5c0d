"""Mart models: dimensions and facts over the intermediate tables.

Facts aggregate before they join wherever the result allows it: a hot product,
customer or day is then folded inside the map tasks and never meets a join whole.
Audit columns and the current date come in as arguments.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import (
    day_number_sunday0,
    days_between,
    greatest_strict,
    mean_of,
    months_before,
    ratio,
    rounded_ratio,
)
from basketry.operators.adjacency import adjacent_pairs
from basketry.operators.distinct_counts import DistinctCount, grouped_distinct_counts
from basketry.operators.merge import newer_than_target

LIST_CHARS = 1000


def _stamp(run_ts: datetime) -> Column:
    return F.lit(run_ts).cast("timestamp_ntz")


# dimensions


def name_list(df: DataFrame, by: list[str], name: str, alias: str) -> DataFrame:
    """Distinct names per group as one sorted ``a, b, c`` text of at most 1000 chars.

    The text is cut, so only the first names matter: past the first, each adds at least
    three characters. The row limit runs before the shuffle too, so a group of any size
    stays small. A group without any name has the empty text.
    """
    enough = LIST_CHARS // 3 + 2
    window = Window.partitionBy(*by).orderBy(F.col(name).asc_nulls_last())
    first_names = (
        df.select(*by, name)
        .distinct()
        .withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") <= enough)
    )
    listed = F.expr(f"listagg({name}, ', ') WITHIN GROUP (ORDER BY {name})")
    return first_names.groupBy(*by).agg(
        F.left(F.coalesce(listed, F.lit("")), F.lit(LIST_CHARS)).alias(alias)
    )


def dim_categories(
    categories: DataFrame, subcategories: DataFrame, products: DataFrame
) -> DataFrame:
    named = categories.select("category_id", "category_name").join(
        subcategories.select("category_id", "subcategory_name"), "category_id", "left"
    )
    hierarchy = name_list(
        named, ["category_id", "category_name"], "subcategory_name", "subcategories"
    ).select("category_id", "subcategories")
    product_names = name_list(products, ["category_id"], "product_name", "product_names")
    return (
        categories.select("category_id", "category_name", "created_at")
        .join(hierarchy, "category_id", "left")
        .join(product_names, "category_id", "left")
        .select("category_id", "category_name", "subcategories", "product_names", "created_at")
    )


def dim_customers(
    customers: DataFrame,
    locations: DataFrame,
    education: DataFrame,
    marital: DataFrame,
    orders: DataFrame,
    as_of: date,
    run_ts: datetime,
) -> DataFrame:
    today = F.lit(as_of).cast("date")
    history = (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"))
    )
    last_day = F.col("last_order")
    status = (
        F.when(last_day >= months_before(today, 3), "Active")
        .when(last_day >= months_before(today, 6), "At Risk")
        .otherwise("Churned")
    )
    return (
        customers.join(history, "customer_id", "left")
        .join(locations.select("location_id", "city", "state", "country"), "location_id", "left")
        .join(education.select("education_id", "education_type"), "education_id", "left")
        .join(
            marital.select("marital_status_id", F.col("status_type").alias("marital_status")),
            "marital_status_id",
            "left",
        )
        .select(
            "customer_id",
            "email",
            "first_name",
            "last_name",
            "age",
            "gender",
            "annual_income",
            "city",
            "state",
            "country",
            "education_type",
            "marital_status",
            status.alias("customer_status"),
            days_between(F.coalesce("first_order", "signup_date"), today).alias(
                "customer_lifetime_days"
            ),
            "signup_date",
            "last_login",
            "is_active",
            "created_at",
            _stamp(run_ts).alias("updated_at"),
        )
    )


def dim_dates(
    orders: DataFrame, interactions: DataFrame, as_of: date, run_ts: datetime
) -> DataFrame:
    """Calendar rows of the dates that occur; days are cut before the distinct.

    ``orders`` are staged orders: an order is dated by its own day and that of its load, which
    its address and items do not change.
    """
    today = F.lit(as_of).cast("date")
    order_days = orders.select(
        F.explode(F.array(F.to_date("order_date"), F.to_date("loaded_at"))).alias("date")
    )
    event_days = interactions.select(F.to_date("event_date").alias("date"))
    day = F.col("date")
    return (
        order_days.unionByName(event_days)
        .distinct()
        .select(
            "date",
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            day_number_sunday0(day).alias("day_of_week"),
            F.trunc(day, "month").alias("first_day_of_month"),
            F.last_day(day).alias("last_day_of_month"),
            F.trunc(day, "year").alias("first_day_of_year"),
            F.when(day == today, "Current")
            .when(day > today, "Future")
            .otherwise("Past")
            .alias("date_status"),
            _stamp(run_ts).alias("created_at"),
        )
    )


def dim_locations(locations: DataFrame) -> DataFrame:
    return locations.select("location_id", "city", "state", "country").distinct()


def dim_products(
    products: DataFrame,
    categories: DataFrame,
    subcategories: DataFrame,
    brands: DataFrame,
    run_ts: datetime,
) -> DataFrame:
    stock = F.col("stock_quantity")
    return (
        products.join(categories.select("category_id", "category_name"), "category_id", "left")
        .join(subcategories.select("subcategory_id", "subcategory_name"), "subcategory_id", "left")
        .join(brands.select("brand_id", "brand_name"), "brand_id", "left")
        .select(
            "product_id",
            "category_id",
            "product_name",
            "description",
            "base_price",
            "sale_price",
            "stock_quantity",
            "category_name",
            "subcategory_name",
            "brand_name",
            "review_count",
            F.coalesce("avg_review_score", F.lit(0.0)).alias("avg_review_score"),
            F.when(stock == 0, "Out of Stock")
            .when(stock < 10, "Low Stock")
            .otherwise("In Stock")
            .alias("inventory_status"),
            "is_active",
            "created_at",
            _stamp(run_ts).alias("updated_at"),
        )
    )


# customer facts


def activity_rows(interactions: DataFrame) -> DataFrame:
    return interactions.select(
        "customer_id",
        F.to_date("event_date").alias("event_date"),
        "event_type",
        "product_id",
        "session_id",
        "device_type",
    ).filter(F.col("event_date").isNotNull() & F.col("customer_id").isNotNull())


def activity_counts() -> tuple[list[str], list[DistinctCount], dict[str, Column]]:
    kind = F.col("event_type")

    def counted(event: str) -> Column:
        return F.when(kind == event, 1).otherwise(0)

    distinct = [
        DistinctCount("unique_products_viewed", "product_id", kind == "view"),
        DistinctCount("unique_products_added", "product_id", kind == "cart_add"),
        DistinctCount("unique_products_purchased", "product_id", kind == "purchase"),
        DistinctCount("total_sessions", "session_id"),
        DistinctCount("devices_used", "device_type"),
    ]
    sums = {
        "views": counted("view"),
        "adds": counted("cart_add"),
        "buys": counted("purchase"),
    }
    return ["customer_id", "event_date"], distinct, sums


def finish_activity(activity: DataFrame, customers: DataFrame, run_ts: datetime) -> DataFrame:
    people = customers.groupBy("customer_id", "email").agg(F.count(F.lit(1)).alias("copies"))
    return activity.join(people, "customer_id").select(
        "customer_id",
        "email",
        "event_date",
        (F.col("views") * F.col("copies")).alias("total_views"),
        "unique_products_viewed",
        (F.col("adds") * F.col("copies")).alias("cart_adds"),
        "unique_products_added",
        (F.col("buys") * F.col("copies")).alias("purchases"),
        "unique_products_purchased",
        "total_sessions",
        "devices_used",
        _stamp(run_ts).alias("updated_at"),
    )


def fct_customer_activity(
    customers: DataFrame, interactions: DataFrame, run_ts: datetime
) -> DataFrame:
    """Events per customer and day, folded before the customer's e-mail is joined."""
    activity = grouped_distinct_counts(activity_rows(interactions), *activity_counts())
    return finish_activity(activity, customers, run_ts)


def fct_customer_orders(
    orders: DataFrame,
    order_items: DataFrame,
    reviews: DataFrame,
    run_ts: datetime,
    target: DataFrame | None = None,
    mode: str = "faithful",
) -> DataFrame:
    """One row per order with item and review figures.

    ``faithful``: the item total counts once per review of the order and once per row
    the order has in ``orders``. With ``target`` only orders past its newest date are
    built (days arrive complete), from the items and reviews of those orders alone.
    """
    if target is not None:
        dated = orders.withColumn("_day", F.to_date("order_date"))
        orders = newer_than_target(dated, "_day", target, "order_date").drop("_day")
        fresh = orders.select("order_id").distinct()
        order_items = order_items.join(fresh, "order_id", "left_semi")
        reviews = reviews.join(fresh, "order_id", "left_semi")
    grain = ["customer_id", "order_id", "order_date", "total_amount"]
    items = (
        order_items.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.countDistinct("product_id").alias("products"), F.sum("quantity").alias("units"))
    )
    scores = (
        reviews.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.count("review_score").alias("scores"),
            F.sum("review_score").alias("score_sum"),
        )
    )
    if mode == "faithful":
        per_review = F.greatest(F.coalesce("reviews", F.lit(1)), F.lit(1))
        total_items = F.sum(F.col("units") * per_review)
    else:
        total_items = F.max("units")
    products = F.coalesce("products", F.lit(0).cast("bigint"))
    return (
        orders.select(*grain)
        .join(items, "order_id", "left")
        .join(scores, "order_id", "left")
        # the grain includes the join key: no shuffle of its own
        .groupBy(*grain)
        .agg(
            F.max("products").alias("products"),
            total_items.alias("total_items"),
            F.max("score_sum").alias("score_sum"),
            F.max("scores").alias("scores"),
        )
        .select(
            "customer_id",
            "order_id",
            F.to_date("order_date").alias("order_date"),
            "total_amount",
            products.alias("unique_products"),
            "total_items",
            ratio(F.col("total_amount"), products).alias("avg_order_value"),
            mean_of(F.col("score_sum"), F.col("scores")).alias("avg_review_score"),
            _stamp(run_ts).alias("created_at"),
        )
    )


def fct_customer_reviews(
    reviews: DataFrame, products: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """Reviews of known products with the product's groups.

    With ``target`` (which then carries ``created_at``) only newer reviews are built,
    and the column is kept for the next run.
    """
    columns = [
        "customer_id",
        "product_id",
        "order_id",
        "review_score",
        "review_text",
        "category_id",
        "subcategory_id",
    ]
    if target is not None:
        reviews = newer_than_target(reviews, "created_at", target, "created_at")
        columns.append("created_at")
    groups = products.select("product_id", "category_id", "subcategory_id")
    return reviews.join(groups, "product_id").select(*columns)


# sales facts


def described_goods(products: DataFrame, categories: DataFrame, brands: DataFrame) -> DataFrame:
    """Names around a product, at product size."""
    return (
        products.select("product_id", "product_name", "category_id", "brand_id")
        .join(categories.select("category_id", "category_name"), "category_id")
        .join(brands.select("brand_id", "brand_name"), "brand_id")
        .select("product_id", "product_name", "category_name", "brand_name")
    )


def named_customers(customers: DataFrame, locations: DataFrame) -> DataFrame:
    """E-mail and place of the customers with a known location."""
    return (
        customers.select("customer_id", "email", "location_id")
        .join(locations.select("location_id", "city", "state"), "location_id")
        .select(
            "customer_id",
            "email",
            F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )
    )


def fct_order_details(
    orders: DataFrame,
    order_items: DataFrame,
    customers: DataFrame,
    locations: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    brands: DataFrame,
    statuses: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    run_ts: datetime,
) -> DataFrame:
    """One wide row per order item (and review of it).

    ``orders`` carry the street and location of their destination, so the address book is not
    met again. Dimensions are widened at their own size, orders get theirs before they meet the
    items, and the items join once per key. ``orders`` may carry the names of their customer
    (``named_customers``), ``order_items`` those of their product (``described_goods``). Small sides are broadcast by their measured
    size only.
    """
    named = ["email", "customer_city", "customer_state"] if "email" in orders.columns else []
    cities = locations.select(
        F.col("location_id").alias("shipping_location_id"),
        F.col("city").alias("shipping_city"),
        F.col("state").alias("shipping_state"),
    )
    heads = (
        orders.select(
            "order_id",
            "customer_id",
            "order_date",
            "status_id",
            "payment_method_id",
            F.col("shipping_street").alias("shipping_address"),
            "shipping_location_id",
            "shipping_cost",
            F.col("total_amount").alias("order_total"),
            "created_at",
            *named,
        )
        .join(statuses.select("status_id", "status_name"), "status_id", "left")
        .join(
            payments.select("payment_method_id", F.col("method_name").alias("payment_method")),
            "payment_method_id",
            "left",
        )
        .join(cities, "shipping_location_id", "left")
    )
    if not named:
        heads = heads.join(named_customers(customers, locations), "customer_id")
    if "product_name" not in order_items.columns:
        order_items = order_items.join(
            described_goods(products, categories, brands).withColumnRenamed("product_id", "_id"),
            F.col("product_id") == F.col("_id"),
        )
    items = order_items.select(
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        F.col("total_price").alias("item_total"),
        "product_name",
        "category_name",
        "brand_name",
    )
    scores = reviews.select("order_id", "product_id", "review_score")
    return (
        heads.join(items, "order_id")
        .join(scores, ["order_id", "product_id"], "left")
        .select(
            "order_id",
            F.to_date("order_date").alias("order_date"),
            "customer_id",
            "email",
            "customer_city",
            "customer_state",
            "product_id",
            "product_name",
            "category_name",
            "brand_name",
            "status_name",
            "payment_method",
            "shipping_address",
            "shipping_city",
            "shipping_state",
            "quantity",
            "unit_price",
            "item_total",
            "shipping_cost",
            "order_total",
            "review_score",
            "created_at",
            _stamp(run_ts).alias("updated_at"),
        )
    )


def fct_product_interactions(interactions: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    days = interactions.select(
        "product_id",
        F.to_date("event_date").alias("event_date"),
        "event_id",
        "event_type",
        "customer_id",
    )
    return grouped_distinct_counts(
        days,
        ["product_id", "event_date"],
        [
            DistinctCount("views", "event_id", kind == "view"),
            DistinctCount("cart_adds", "event_id", kind == "cart_add"),
            DistinctCount("wishlist_adds", "event_id", kind == "wishlist_add"),
            DistinctCount("unique_customers", "customer_id"),
        ],
    )


def order_days(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", F.to_date("order_date").alias("date"))


def _dated_items(orders: DataFrame, order_items: DataFrame, *columns: str) -> DataFrame:
    """Items with the day of their order, once per order row; they may carry it already."""
    if "date" in order_items.columns:
        return order_items.select("order_id", "product_id", *columns, "date")
    return order_items.select("order_id", "product_id", *columns).join(order_days(orders), "order_id")


def fct_product_performance(
    products: DataFrame, order_items: DataFrame, orders: DataFrame, run_ts: datetime
) -> DataFrame:
    """Daily sales per product with margin and a reorder flag.

    Items fold to (product, day) first; prices and stock join that small table, and the
    trailing average is one window over it: at most one row per product and day.
    ``total_orders`` counts distinct quantities and the window spans 31 observed days,
    both as in the results to match. Undated items leave after they are grouped: up to there
    the rows are those of the sales by product.
    """
    daily = (
        _dated_items(orders, order_items, "quantity", "total_price")
        .groupBy("product_id", "date")
        .agg(
            F.countDistinct("quantity").alias("total_orders"),
            F.sum("quantity").alias("units"),
            F.sum("total_price").alias("sales"),
            F.count("date").alias("dated"),
        )
        .filter(F.col("dated") > 0)
    )
    shelf = (
        products.groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("base_price").alias("base_price"),
            F.min("stock_quantity").alias("stock_level"),
        )
    )
    units, revenue = F.col("units_sold"), F.col("revenue")
    margin = F.when(
        revenue > 0, rounded_ratio((revenue - units * F.col("base_price")) * 100, revenue, 2)
    ).otherwise(F.lit(0).cast("decimal(24,2)"))
    trailing = Window.partitionBy("product_id").orderBy("date").rowsBetween(-30, 0)
    needed = F.col("stock_level") <= greatest_strict(F.col("velocity") * 7, F.lit(10.0))
    return (
        daily.join(shelf, "product_id")
        .withColumn("units_sold", F.col("units") * F.col("copies"))
        .withColumn("revenue", F.col("sales") * F.col("copies"))
        .withColumn("velocity", F.avg("units_sold").over(trailing))
        .select(
            "product_id",
            "date",
            "total_orders",
            "units_sold",
            "revenue",
            margin.alias("profit_margin"),
            "stock_level",
            F.coalesce(needed, F.lit(False)).alias("reorder_flag"),
            _stamp(run_ts).alias("created_at"),
        )
    )


def sales_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.to_date("order_date").alias("sale_date"),
        "order_id",
        "customer_id",
        "total_amount",
        "shipping_cost",
    )


def sales_counts() -> tuple[list[str], list[DistinctCount], dict[str, Column]]:
    amount = F.col("total_amount")
    distinct = [
        DistinctCount("total_orders", "order_id"),
        DistinctCount("unique_customers", "customer_id"),
    ]
    sums = {
        "total_revenue": amount,
        "total_shipping": F.col("shipping_cost"),
        "net_revenue": amount - F.col("shipping_cost"),
        "amounts": F.when(amount.isNotNull(), 1),
    }
    return ["sale_date"], distinct, sums


def finish_sales(days: DataFrame, run_ts: datetime) -> DataFrame:
    return days.select(
        "sale_date",
        "total_orders",
        "unique_customers",
        "total_revenue",
        "total_shipping",
        "net_revenue",
        mean_of(F.col("total_revenue"), F.col("amounts")).alias("avg_order_value"),
        ratio(F.col("total_revenue"), F.col("unique_customers")).alias("revenue_per_customer"),
        _stamp(run_ts).alias("updated_at"),
    )


def fct_sales_by_date(orders: DataFrame, run_ts: datetime) -> DataFrame:
    return finish_sales(grouped_distinct_counts(sales_rows(orders), *sales_counts()), run_ts)


def fct_sales_by_product(
    products: DataFrame, order_items: DataFrame, orders: DataFrame, run_ts: datetime
) -> DataFrame:
    """Sales per product and day, folded before the product's category joins."""
    daily = (
        _dated_items(orders, order_items, "quantity", "total_price", "unit_price")
        .groupBy("product_id", "date")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("units"),
            F.sum("total_price").alias("sales"),
            F.sum("unit_price").alias("price_sum"),
            F.count("unit_price").alias("prices"),
        )
    )
    groups = products.groupBy("product_id", "category_id").agg(F.count(F.lit(1)).alias("copies"))
    return daily.join(groups, "product_id").select(
        "product_id",
        "category_id",
        F.col("date").alias("order_date"),
        "total_orders",
        (F.col("units") * F.col("copies")).alias("units_sold"),
        (F.col("sales") * F.col("copies")).alias("revenue"),
        mean_of(F.col("price_sum"), F.col("prices")).alias("avg_selling_price"),
        _stamp(run_ts).alias("created_at"),
    )


def fct_sales_by_region(orders: DataFrame, customers: DataFrame, run_ts: datetime) -> DataFrame:
    where = customers.select("customer_id", "location_id")
    days = orders.select(
        "order_id", "customer_id", F.to_date("order_date").alias("date"), "total_amount"
    ).join(where, "customer_id")
    return grouped_distinct_counts(
        days,
        ["location_id", "date"],
        [
            DistinctCount("total_orders", "order_id"),
            DistinctCount("customer_count", "customer_id"),
        ],
        {"total_revenue": F.col("total_amount")},
    ).select(
        "location_id",
        "date",
        "total_orders",
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"),
        "customer_count",
        _stamp(run_ts).alias("created_at"),
    )


def customer_journey(
    order_items: DataFrame, orders: DataFrame, categories: DataFrame
) -> DataFrame:
    """Customers who bought one category right after another.

    The declared mart has no SQL; this reading follows its column descriptions: items
    of a customer in the order of order date, order id, item id and product id, and
    for each pair of neighbouring categories the number of distinct customers.
    """
    days = orders.select("order_id", "order_date").distinct()
    steps = order_items.join(days, "order_id").filter(F.col("customer_id").isNotNull())
    moves = (
        adjacent_pairs(
            steps,
            "customer_id",
            ["order_date", "order_id", "order_item_id", "product_id"],
            "category_id",
        )
        .select("sequence", "source", "target")
        .distinct()
    )
    names = categories.select("category_id", "category_name")
    return (
        moves.join(
            names.select(
                F.col("category_id").alias("source"), F.col("category_name").alias("source_category")
            ),
            "source",
        )
        .join(
            names.select(
                F.col("category_id").alias("target"), F.col("category_name").alias("target_category")
            ),
            "target",
        )
        .groupBy("source_category", "target_category")
        .agg(F.countDistinct("sequence").alias("flow_value"))
    )
