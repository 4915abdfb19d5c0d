"""Intermediate models: lookups, entities and transactions over staging.

Surrogate keys are pure functions of the values they stand for, and every lookup is
built from the very rows that refer to it. A join to a lookup only to fetch its key
is therefore a projection here, and the facts shuffle once less per lookup.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import address_part, is_blank, key_text, mean_of, surrogate_key


def _run_timestamp(run_ts: datetime) -> Column:
    return F.lit(run_ts).cast("timestamp_ntz")


def key_or_null(value: Column) -> Column:
    """Key of a lookup value; NULL has no lookup row, hence no key."""
    return F.when(value.isNotNull(), surrogate_key(value))


def brand_key(brand: Column) -> Column:
    trimmed = F.trim(brand)
    return F.when(trimmed != "", surrogate_key(trimmed))


# lookups


def build_lookup(
    df: DataFrame, column: str, id_name: str, value_name: str, run_ts: datetime
) -> DataFrame:
    """Distinct non-NULL values of a column with their surrogate key."""
    return (
        df.filter(F.col(column).isNotNull())
        .select(F.col(column).alias(value_name))
        .distinct()
        .select(
            surrogate_key(value_name).alias(id_name),
            value_name,
            _run_timestamp(run_ts).alias("created_at"),
        )
    )


def education_types(stg_customers: DataFrame, run_ts: datetime) -> DataFrame:
    return build_lookup(stg_customers, "education", "education_id", "education_type", run_ts)


def marital_statuses(stg_customers: DataFrame, run_ts: datetime) -> DataFrame:
    return build_lookup(
        stg_customers, "marital_status", "marital_status_id", "status_type", run_ts
    )


def order_statuses(stg_orders: DataFrame, run_ts: datetime) -> DataFrame:
    return build_lookup(stg_orders, "status", "status_id", "status_name", run_ts)


def payment_methods(stg_orders: DataFrame, run_ts: datetime) -> DataFrame:
    return build_lookup(stg_orders, "payment_method", "payment_method_id", "method_name", run_ts)


# entities


def brands(stg_products: DataFrame, run_ts: datetime) -> DataFrame:
    trimmed = stg_products.select(F.trim("brand").alias("brand")).filter("brand <> ''")
    return build_lookup(trimmed, "brand", "brand_id", "brand_name", run_ts)


def locations(stg_orders: DataFrame, stg_customers: DataFrame, run_ts: datetime) -> DataFrame:
    """Every complete (city, state, country) seen in an address or a customer row.

    Both addresses of an order come from one scan, and one distinct covers all sides.
    """
    address = F.explode(F.array("shipping_address", "billing_address"))
    from_orders = stg_orders.select(address.alias("address")).select(
        address_part(F.col("address"), -3).alias("city"),
        address_part(F.col("address"), -2).alias("state"),
        address_part(F.col("address"), -1).alias("country"),
    )
    from_customers = stg_customers.select(
        *[F.trim(c).alias(c) for c in ("city", "state", "country")]
    )
    complete = (F.col("city") != "") & (F.col("state") != "") & (F.col("country") != "")
    return (
        from_orders.filter(complete)
        .unionByName(from_customers.filter(complete))
        .distinct()
        .select(
            surrogate_key("city", "state", "country").alias("location_id"),
            "city",
            "state",
            "country",
            _run_timestamp(run_ts).alias("created_at"),
        )
    )


def street_places(stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Distinct street texts with the place of the ordering customer, as the text under its key.

    One join and one distinct: both street columns of an order travel in one row.
    """
    places = stg_customers.select("customer_id", key_text("city", "state", "country").alias("place"))
    streets = stg_orders.select("customer_id", "shipping_address", "billing_address")
    return (
        streets.join(places, "customer_id")
        .select(
            "place", F.explode(F.array("shipping_address", "billing_address")).alias("street_address")
        )
        .filter(F.col("street_address").isNotNull())
        .distinct()
    )


def addresses(stg_orders: DataFrame, stg_customers: DataFrame, run_ts: datetime) -> DataFrame:
    """Distinct street texts with the city, state and country of the ordering customer.

    The location key is a function of the customer's untrimmed city, state and country,
    whether or not such a location row exists. Both keys are made of the street and the text
    under the location key, so the distinct is over these, and keys are made after it.
    """
    return street_places(stg_orders, stg_customers).select(
        surrogate_key("street_address", "place").alias("address_id"),
        "street_address",
        F.md5("place").alias("location_id"),
        _run_timestamp(run_ts).alias("created_at"),
    )


def _count_per(df: DataFrame, by: str, counted: str, alias: str) -> DataFrame:
    return (
        df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.countDistinct(counted).alias(alias))
    )


def categories_enriched(
    stg_categories: DataFrame, stg_subcategories: DataFrame, stg_products: DataFrame
) -> DataFrame:
    """Subcategories and products per category, each side counted before it joins."""
    zero = F.lit(0).cast("bigint")
    return (
        stg_categories.select("category_id", "category_name", "created_at")
        .distinct()
        .join(
            _count_per(stg_subcategories, "category_id", "subcategory_id", "subcategory_count"),
            "category_id",
            "left",
        )
        .join(
            _count_per(stg_products, "category_id", "product_id", "product_count"),
            "category_id",
            "left",
        )
        .select(
            "category_id",
            "category_name",
            F.coalesce("subcategory_count", zero).alias("subcategory_count"),
            F.coalesce("product_count", zero).alias("product_count"),
            "created_at",
        )
    )


def subcategories_enriched(stg_subcategories: DataFrame, stg_products: DataFrame) -> DataFrame:
    return (
        stg_subcategories.select("subcategory_id", "subcategory_name", "category_id", "created_at")
        .distinct()
        .join(
            _count_per(stg_products, "subcategory_id", "product_id", "product_count"),
            "subcategory_id",
            "left",
        )
        .select(
            "subcategory_id",
            "subcategory_name",
            "category_id",
            F.coalesce("product_count", F.lit(0).cast("bigint")).alias("product_count"),
            "created_at",
        )
    )


def customers_enriched(stg_customers: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Customers with a complete location, lookup keys and their order history."""
    history = (
        stg_orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("total_amount").alias("total_spent"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    place = [F.trim(c) for c in ("city", "state", "country")]
    complete = ~is_blank(F.col("city")) & ~is_blank(F.col("state")) & ~is_blank(F.col("country"))
    return (
        stg_customers.filter(complete)
        .join(history, "customer_id", "left")
        .select(
            "customer_id",
            "email",
            "first_name",
            "last_name",
            "age",
            "gender",
            "annual_income",
            key_or_null(F.col("education")).alias("education_id"),
            key_or_null(F.col("marital_status")).alias("marital_status_id"),
            surrogate_key(*place).alias("location_id"),
            "signup_date",
            "last_login",
            "preferred_channel",
            "is_active",
            F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
            F.coalesce("total_spent", F.lit(0).cast("decimal(22,2)")).alias("total_spent"),
            "first_order_date",
            "last_order_date",
            F.col("loaded_at").alias("created_at"),
        )
    )


def products_enriched(
    stg_products: DataFrame, stg_order_items: DataFrame, stg_reviews: DataFrame
) -> DataFrame:
    """Products with brand key, sales totals and review totals."""
    sales = (
        stg_order_items.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum("total_price").alias("total_revenue"),
        )
    )
    reviews = (
        stg_reviews.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("review_total"),
            mean_of(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return (
        stg_products.filter(F.col("product_id").isNotNull())
        .join(sales, "product_id", "left")
        .join(reviews, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "description",
            "base_price",
            "sale_price",
            "stock_quantity",
            "weight_kg",
            "is_active",
            brand_key(F.col("brand")).alias("brand_id"),
            "category_id",
            "subcategory_id",
            F.coalesce("total_orders", zero).alias("total_orders"),
            F.coalesce("total_quantity_sold", zero).alias("total_quantity_sold"),
            F.coalesce("total_revenue", F.lit(0).cast("decimal(22,2)")).alias("total_revenue"),
            F.coalesce("review_total", zero).alias("review_count"),
            "avg_review_score",
            "created_at",
        )
    )


def reviews_enriched(
    stg_reviews: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    subcategories: DataFrame,
    brand_names: DataFrame,
) -> DataFrame:
    """Reviews with the names around their product.

    The product side is widened first, at product size; the reviews join it once.
    """
    described = (
        products.select("product_id", "product_name", "category_id", "subcategory_id", "brand_id")
        .join(categories.select("category_id", "category_name"), "category_id", "left")
        .join(subcategories.select("subcategory_id", "subcategory_name"), "subcategory_id", "left")
        .join(brand_names.select("brand_id", "brand_name"), "brand_id", "left")
        .select("product_id", "product_name", "category_name", "subcategory_name", "brand_name")
    )
    return stg_reviews.join(described, "product_id", "left").select(
        "review_id",
        "product_id",
        "order_id",
        "customer_id",
        "review_score",
        "review_text",
        "product_name",
        "category_name",
        "subcategory_name",
        "brand_name",
        F.col("loaded_at").alias("created_at"),
    )


# transactions


def customer_interactions(stg_interactions: DataFrame, stg_products: DataFrame) -> DataFrame:
    groups = stg_products.select("product_id", "category_id", "subcategory_id")
    return stg_interactions.join(groups, "product_id", "left").select(
        "event_id",
        "customer_id",
        "product_id",
        "category_id",
        "subcategory_id",
        "event_type",
        "event_date",
        "device_type",
        "session_id",
        "created_at",
    )


def latest_review_scores(stg_reviews: DataFrame) -> DataFrame:
    """Score of the most recently loaded review per order and product.

    An unknown load time counts as newest; equal times go to the greater review id.
    """
    known = stg_reviews.filter(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
    newest = F.struct(
        F.col("loaded_at").isNull(), "loaded_at", "review_id", F.col("review_score").isNotNull()
    )
    return known.groupBy("order_id", "product_id").agg(
        F.max_by("review_score", newest).alias("review_score")
    )


def order_items(
    stg_order_items: DataFrame,
    stg_orders: DataFrame,
    products: DataFrame,
    stg_reviews: DataFrame,
    days: DataFrame | None = None,
    goods: DataFrame | None = None,
) -> DataFrame:
    """Distinct items of known products, with customer, product groups and review score.

    Items are dealt out once for their first join and made distinct after it, where they lie:
    every other side is distinct by itself, so the result is too, and a plan that needs no
    review score drops that join altogether. Orders and reviews join first, while
    rows are narrow and lie by order; the product's groups, wide as they are, come last.

    Rows that a reader would join on come along where items lie anyway: ``days`` (order id and
    more) with the orders; ``goods`` (product id and more) with the product's groups, which then
    come first, so that the items end up lying by order.
    """
    items = stg_order_items.select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        "total_price",
        "created_at",
    ).filter(F.col("product_id").isNotNull())
    groups = products.select("product_id", "category_id", "subcategory_id", "brand_id").distinct()
    buyers = stg_orders.select("order_id", "customer_id").distinct()

    def by_order(rows: DataFrame) -> DataFrame:
        rows = rows.join(buyers, "order_id", "left")
        return rows.distinct() if goods is None else rows

    def by_product(rows: DataFrame) -> DataFrame:
        rows = rows.join(groups, "product_id")
        return rows if goods is None else rows.distinct().join(goods, "product_id")

    if goods is not None:
        items = by_product(items)
    rows = by_order(items).join(latest_review_scores(stg_reviews), ["order_id", "product_id"], "left")
    if days is not None:
        rows = rows.join(days, "order_id")
    if goods is None:
        rows = by_product(rows)
    return rows.select(
        "order_item_id",
        "order_id",
        "product_id",
        "customer_id",
        "quantity",
        "unit_price",
        "total_price",
        "category_id",
        "subcategory_id",
        "brand_id",
        "review_score",
        "created_at",
        *[c for more in (days, goods) if more is not None for c in more.columns if not c.endswith("_id")],
    )


_ORDER_GROUP = [
    "order_id",
    "customer_id",
    "order_date",
    "status",
    "payment_method",
    "shipping_key",
    "billing_key",
    "total_amount",
    "shipping_cost",
    "created_at",
]


def orders(
    stg_orders: DataFrame,
    stg_order_items: DataFrame,
    stg_reviews: DataFrame,
    address_book: DataFrame,
    stg_customers: DataFrame,
    mode: str = "faithful",
    destination: bool = False,
    people: DataFrame | None = None,
) -> DataFrame:
    """Orders with lookup keys, address keys, item totals and review totals.

    ``faithful`` keeps two effects of joining everything before grouping: the item
    quantity counts once per review of the order, and a street known in several cities
    yields one order row per city. The first is a product of two pre-aggregates, so
    items and reviews are never multiplied out. ``corrected`` counts each item once and
    takes the address of the ordering customer, without any address join.

    ``address_book`` is the published table of addresses or, to the same effect, ``street_places``.
    Keys that are no sooner needed are made after the grouping: what rows are dealt out with is the
    text under them, which tells rows apart as the keys do and is smaller.

    With ``destination`` the street and location key of the shipping address come along (the
    address key decides both), so that no reader has to look the address up again. Rows of ``people``
    (customer id and more) that a reader would join on come along too: orders then lie by customer
    when they are grouped. Copies of such a row are folded and counted, and unfolded at the end.
    """
    if mode not in ("faithful", "corrected"):
        raise ValueError(f"unknown mode {mode}")
    items = (
        stg_order_items.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.countDistinct("product_id").alias("products"),
            F.sum("quantity").alias("units"),
        )
    )
    reviews = (
        stg_reviews.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.count("review_score").alias("scores"),
            F.sum("review_score").alias("score_sum"),
        )
    )
    keyed = stg_orders.select(
        "order_id",
        "customer_id",
        "order_date",
        "status",
        "payment_method",
        "shipping_address",
        "billing_address",
        "total_amount",
        "shipping_cost",
        F.col("loaded_at").alias("created_at"),
    )
    published = mode == "faithful" and "address_id" in address_book.columns
    if mode == "faithful":
        found = ["address_id", "location_id"] if published else ["place"]
        for role in ("shipping", "billing"):
            keyed = keyed.join(
                address_book.select(
                    F.col("street_address").alias(f"{role}_address"),
                    *[F.col(c).alias(f"{role}_{c}") for c in found],
                ),
                f"{role}_address",
                "left",
            )
        units = F.col("units") * F.greatest(F.coalesce("reviews", F.lit(1)), F.lit(1))
    else:
        places = (
            stg_customers.filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.min(F.struct("city", "state", "country")).alias("place"))
        )
        keyed = keyed.join(places, "customer_id", "left")
        place = key_text(*[F.col(f"place.{c}") for c in ("city", "state", "country")])
        for role in ("shipping", "billing"):
            known = F.col(f"{role}_address").isNotNull() & F.col("place").isNotNull()
            keyed = keyed.withColumn(f"{role}_place", F.when(known, place))
        units = F.col("units")
    for role in ("shipping", "billing"):
        street, place = F.col(f"{role}_address"), F.col(f"{role}_{'address_id' if published else 'place'}")
        key = place if published else F.when(place.isNotNull(), key_text(street, place))
        keyed = keyed.withColumn(f"{role}_key", key)
    total_items = F.sum(units) if mode == "faithful" else F.max(units)

    def key_of(text: str) -> Column:
        return F.col(text) if published else F.md5(text)

    group = _ORDER_GROUP
    location = "shipping_location_id" if published else "shipping_place"
    if destination:
        known = F.col("shipping_key").isNotNull()
        keyed = keyed.withColumn("shipping_street", F.when(known, F.col("shipping_address")))
        group = [*group, "shipping_street", location]
        if not published:  # the two make the key
            group.remove("shipping_key")
    described = []
    if people is not None:
        described = [c for c in people.columns if c != "customer_id"]
        folded = people.groupBy(*people.columns).agg(F.count(F.lit(1)).alias("_copies"))
        keyed = keyed.join(folded, "customer_id")
        group = [*group, *described, "_copies"]
    shipping = F.md5(key_text("shipping_street", location)) if "shipping_key" not in group else key_of("shipping_key")
    grouped = (
        keyed.join(items, "order_id", "left")
        .join(reviews, "order_id", "left")
        # grouping keys include the join key: no shuffle of its own
        .groupBy(*group)
        .agg(
            F.coalesce(F.max("products"), F.lit(0).cast("bigint")).alias("unique_products"),
            total_items.alias("total_items"),
            F.coalesce(F.bool_or(F.col("scores") > 0), F.lit(False)).alias("has_review"),
            mean_of(F.max("score_sum"), F.max("scores")).alias("avg_review_score"),
        )
    )
    if people is not None:
        grouped = grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return grouped.select(
        "order_id",
        "customer_id",
        "order_date",
        key_or_null(F.col("status")).alias("status_id"),
        key_or_null(F.col("payment_method")).alias("payment_method_id"),
        (F.when(F.col("shipping_street").isNotNull(), shipping) if destination else shipping).alias(
            "shipping_address_id"
        ),
        key_of("billing_key").alias("billing_address_id"),
        "total_amount",
        "shipping_cost",
        "unique_products",
        "total_items",
        "has_review",
        "avg_review_score",
        "created_at",
        *(["shipping_street", key_of(location).alias("shipping_location_id")] if destination else []),
        *described,
    )
