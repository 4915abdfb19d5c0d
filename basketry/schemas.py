"""Registry of the eight raw tables: columns, keys, dates, origin."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

METADATA_COLUMNS = ("data_source", "batch_id", "loaded_at")
_METADATA_TYPES = {"data_source": "string", "batch_id": "string", "loaded_at": "timestamp"}


@dataclass(frozen=True)
class TableSpec:
    """One raw table. ``columns`` are the staged names and types, in order."""

    name: str
    primary_key: str
    date_column: str
    origin: str  # "json" (object storage extract) or "relational"
    columns: dict[str, str]
    fallback_dates: tuple[str, ...] = ()
    replace_only: bool = False  # refreshed whole, no history kept

    @property
    def staged(self) -> dict[str, str]:
        return {**self.columns, **_METADATA_TYPES}

    def struct(self) -> T.StructType:
        """Explicit read schema for text formats: ids and timestamps stay text until staging."""
        kinds = {
            "string": T.StringType(),
            "int": T.IntegerType(),
            "boolean": T.BooleanType(),
            "timestamp": T.StringType(),
        }
        return T.StructType(
            [
                T.StructField(name, kinds.get(kind, T.DoubleType()))
                for name, kind in self.columns.items()
            ]
        )


_SPECS = [
    TableSpec(
        "categories",
        "category_id",
        "created_at",
        "relational",
        {"category_id": "string", "category_name": "string", "created_at": "timestamp"},
        replace_only=True,
    ),
    TableSpec(
        "subcategories",
        "subcategory_id",
        "created_at",
        "relational",
        {
            "subcategory_id": "string",
            "category_id": "string",
            "subcategory_name": "string",
            "created_at": "timestamp",
        },
        replace_only=True,
    ),
    TableSpec(
        "customers",
        "customer_id",
        "signup_date",
        "json",
        {
            "customer_id": "string",
            "email": "string",
            "first_name": "string",
            "last_name": "string",
            "age": "int",
            "gender": "string",
            "annual_income": "decimal(12,2)",
            "marital_status": "string",
            "education": "string",
            "location_type": "string",
            "city": "string",
            "state": "string",
            "country": "string",
            "signup_date": "timestamp",
            "last_login": "timestamp",
            "preferred_channel": "string",
            "is_active": "boolean",
        },
        ("last_login", "created_at"),
    ),
    TableSpec(
        "products",
        "product_id",
        "created_at",
        "json",
        {
            "product_id": "string",
            "category_id": "string",
            "subcategory_id": "string",
            "product_name": "string",
            "description": "string",
            "base_price": "decimal(12,2)",
            "sale_price": "decimal(12,2)",
            "stock_quantity": "int",
            "weight_kg": "decimal(8,2)",
            "is_active": "boolean",
            "created_at": "timestamp",
            "brand": "string",
            "sku": "string",
            "rating": "decimal(3,1)",
            "review_count": "int",
        },
    ),
    TableSpec(
        "orders",
        "order_id",
        "order_date",
        "json",
        {
            "order_id": "string",
            "customer_id": "string",
            "order_date": "timestamp",
            "status": "string",
            "total_amount": "decimal(12,2)",
            "shipping_cost": "decimal(12,2)",
            "payment_method": "string",
            "shipping_address": "string",
            "billing_address": "string",
            "created_at": "timestamp",
            "updated_at": "timestamp",
        },
        ("created_at", "updated_at"),
    ),
    TableSpec(
        "order_items",
        "order_item_id",
        "created_at",
        "relational",
        {
            "order_item_id": "string",
            "order_id": "string",
            "product_id": "string",
            "quantity": "int",
            "unit_price": "decimal(12,2)",
            "total_price": "decimal(12,2)",
            "created_at": "timestamp",
        },
        ("order_date",),
    ),
    TableSpec(
        "interactions",
        "event_id",
        "event_date",
        "relational",
        {
            "event_id": "string",
            "customer_id": "string",
            "product_id": "string",
            "event_type": "string",
            "event_date": "timestamp",
            "device_type": "string",
            "session_id": "string",
            "created_at": "timestamp",
        },
        ("created_at",),
    ),
    TableSpec(
        "reviews",
        "review_id",
        "created_at",
        "json",
        {
            "review_id": "string",
            "product_id": "string",
            "order_id": "string",
            "customer_id": "string",
            "review_score": "int",
            "review_text": "string",
        },
        ("order_date",),
    ),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}


def table_spec(name: str) -> TableSpec | None:
    """Registry entry; an extract prefixed ``latest_`` is the same table."""
    return TABLES.get(name.lower().removeprefix("latest_"))


def primary_key(name: str) -> str:
    """Key column of a table; tables nobody registered are keyed by ``id``."""
    spec = table_spec(name)
    return spec.primary_key if spec else "id"


def date_column(name: str) -> str | None:
    """Cut-over date of a table."""
    spec = table_spec(name)
    return spec.date_column if spec else None


def valid_date_column(name: str, columns: list[str]) -> str | None:
    """First of the table's date candidates that is present."""
    spec = table_spec(name)
    candidates = (spec.date_column, *spec.fallback_dates) if spec else ("created_at",)
    present = {column.lower() for column in columns}
    return next((c for c in candidates if c in present), None)
