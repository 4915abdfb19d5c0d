"""The declared checks of each layer."""

from __future__ import annotations

from basketry.operators.quality import Check


def _table(
    name: str,
    unique: str = "",
    not_null: str = "",
    refs: dict[str, str] | None = None,
    warn: dict[str, str] | None = None,
    grain: str = "",
) -> list[Check]:
    checks = [Check(name, c, "unique") for c in unique.split()]
    checks += [Check(name, c, "not_null") for c in not_null.split()]
    checks += [Check(name, c, "relationships", p) for c, p in (refs or {}).items()]
    checks += [Check(name, c, "relationships", p, "warn") for c, p in (warn or {}).items()]
    if grain:
        checks.append(Check(name, grain, "grain"))
    return checks


_CUSTOMER = {"customer_id": "customers.customer_id"}
_PRODUCT = {"product_id": "products.product_id"}
_ORDER = {"order_id": "orders.order_id"}

# Raw tables, named as in the registry.
RAW_CHECKS: list[Check] = [
    *_table("categories", "category_id", "category_id category_name"),
    *_table("customers", "customer_id", "customer_id email"),
    *_table("interactions", "event_id", "event_id customer_id product_id", _CUSTOMER | _PRODUCT),
    *_table("order_items", "order_item_id", "order_item_id order_id product_id", _ORDER | _PRODUCT),
    *_table("orders", "order_id", "order_id customer_id", _CUSTOMER),
    *_table(
        "products",
        "product_id",
        "product_id category_id subcategory_id",
        {
            "category_id": "categories.category_id",
            "subcategory_id": "subcategories.subcategory_id",
        },
    ),
    *_table("reviews", "", "product_id order_id customer_id", _PRODUCT | _ORDER | _CUSTOMER),
    *_table(
        "subcategories",
        "subcategory_id",
        "subcategory_id category_id",
        {"category_id": "categories.category_id"},
    ),
]

STAGING_CHECKS: list[Check] = [
    *_table("stg_categories", "category_id", "category_id category_name"),
    *_table("stg_customers", "customer_id", "customer_id email"),
    *_table("stg_interactions", "event_id", "event_id customer_id product_id"),
    *_table("stg_order_items", "order_item_id", "order_item_id order_id product_id"),
    *_table("stg_orders", "order_id", "order_id customer_id"),
    *_table("stg_products", "product_id", "product_id category_id subcategory_id"),
    *_table("stg_reviews", "", "product_id order_id customer_id"),
    *_table("stg_subcategories", "subcategory_id", "subcategory_id category_id"),
]

_TO_CUSTOMERS = {"customer_id": "customers_enriched.customer_id"}
_TO_PRODUCTS = {"product_id": "products_enriched.product_id"}

INTERMEDIATE_CHECKS: list[Check] = [
    *_table("locations", "location_id", "location_id city state country"),
    *_table("brands", "brand_id", "brand_id brand_name"),
    *_table("education_types", "education_id", "education_id education_type"),
    *_table("marital_statuses", "marital_status_id", "marital_status_id status_type"),
    *_table("order_statuses", "status_id", "status_id status_name"),
    *_table("payment_methods", "payment_method_id", "payment_method_id method_name"),
    *_table("addresses", "address_id", "address_id", {"location_id": "locations.location_id"}),
    *_table(
        "customers_enriched",
        "customer_id",
        "customer_id",
        {
            "education_id": "education_types.education_id",
            "location_id": "locations.location_id",
        },
    ),
    *_table(
        "products_enriched",
        "product_id",
        "product_id",
        {"category_id": "categories_enriched.category_id", "brand_id": "brands.brand_id"},
    ),
    *_table(
        "orders",
        "order_id",
        "order_id",
        _TO_CUSTOMERS | {"status_id": "order_statuses.status_id"},
    ),
    *_table("order_items", "order_item_id", "order_item_id", {"order_id": "orders.order_id"}, _TO_PRODUCTS),
    *_table("customer_interactions", "event_id", "event_id", _TO_CUSTOMERS | _TO_PRODUCTS),
    *_table(
        "subcategories_enriched",
        "subcategory_id",
        "subcategory_id",
        {"category_id": "categories_enriched.category_id"},
    ),
    *_table(
        "reviews_enriched",
        "",
        "product_id order_id customer_id",
        _TO_PRODUCTS | _TO_CUSTOMERS | {"order_id": "orders.order_id"},
    ),
]

_DIM_CUSTOMER = {"customer_id": "dim_customers.customer_id"}
_DIM_PRODUCT = {"product_id": "dim_products.product_id"}

# Some declared unique keys are coarser than the rows (order details are per item, sales
# by product and product performance per day, customer orders per order). The grain checks
# name the real key; the declared one stays as a warning.
MART_CHECKS: list[Check] = [
    *_table("dim_dates", "date", "date"),
    *_table("dim_categories", "category_id", "category_id"),
    *_table("dim_products", "product_id", "product_id"),
    *_table("dim_customers", "customer_id", "customer_id customer_status"),
    *_table(
        "fct_customer_activity",
        "",
        "customer_id event_date",
        _DIM_CUSTOMER,
        grain="customer_id, event_date",
    ),
    *_table("fct_order_details", "", "order_id order_date", _DIM_CUSTOMER | _DIM_PRODUCT),
    *_table("fct_sales_by_date", "sale_date", "sale_date total_revenue total_orders"),
    *_table(
        "fct_sales_by_product",
        "",
        "product_id",
        _DIM_PRODUCT,
        grain="product_id, category_id, order_date",
    ),
    *_table(
        "fct_sales_by_region",
        "",
        "location_id date",
        {"location_id": "locations.location_id"},
        grain="location_id, date",
    ),
    *_table("fct_customer_orders", "", "customer_id", _DIM_CUSTOMER, grain="customer_id, order_id"),
    *_table(
        "fct_customer_reviews",
        "",
        "customer_id product_id order_id",
        _DIM_CUSTOMER | _DIM_PRODUCT,
        grain="customer_id, product_id, order_id",
    ),
    *_table("fct_product_performance", "", "product_id", _DIM_PRODUCT, grain="product_id, date"),
    *_table(
        "fct_product_interactions", "", "product_id", _DIM_PRODUCT, grain="product_id, event_date"
    ),
    Check("fct_order_details", "order_id", "unique", severity="warn"),
    Check("fct_sales_by_product", "product_id", "unique", severity="warn"),
    Check("fct_product_performance", "product_id", "unique", severity="warn"),
    Check("fct_customer_orders", "customer_id", "unique", severity="warn"),
]
